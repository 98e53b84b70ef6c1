"""Clinical concept tables from charted intensive-care data, as Spark DataFrames."""

from wardline.plans.creatinine import kdigo_creatinine
from wardline.plans.derive import derive
from wardline.plans.dialysis import dialysis_events
from wardline.plans.mcs import mcs_events
from wardline.plans.stages import kdigo_stages
from wardline.plans.urine_output import urine_output
from wardline.plans.urine_rate import kdigo_uo
from wardline.plans.weight_durations import weight_durations

__all__ = [
    "derive",
    "dialysis_events",
    "kdigo_creatinine",
    "kdigo_stages",
    "kdigo_uo",
    "mcs_events",
    "urine_output",
    "weight_durations",
]
