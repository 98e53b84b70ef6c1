"""Charted strings and the concepts they stand for.

Everything in this module is a fixed value: the strings are matched whole, with
case, spacing and trailing blanks as charted, and must stay exactly as they are
for the results to be right. A string listed twice carries two labels.
"""

from __future__ import annotations

# --- Mechanical circulatory support -------------------------------------------------

MCS_TREATMENT = (
    ("cardiovascular|cardiac surgery|artificial heart implantation", "ArtificialHeart"),
    ("cardiovascular|cardiac surgery|implantation of BIVAD", "BIVAD"),
    ("cardiovascular|cardiac surgery|implantation of RVAD", "RVAD"),
    ("cardiovascular|cardiac surgery|implantation of LVAD", "LVAD"),
    ("cardiovascular|non-operative procedures|intraaortic balloon pump removal", "IABP_discontinued"),
    ("cardiovascular|non-operative procedures|intraaortic balloon pump", "IABP"),
    ("cardiovascular|shock|intraaortic balloon pump", "IABP"),
)

MCS_NURSE_CHART = (
    ("LVAD", "LVAD"),
    ("Impella", "Impella"),
    ("ECMO", "ECMO"),
)

MCS_ASSESSMENT_CELL = "Ventricular Assist Device"

MCS_ASSESSMENT = (
    ("Impella", "Impella"),
    ("IMPELLA", "Impella"),
    ("Impella, IABP", "Impella"),
    ("P8/purge flow 11.1", "Impella"),
    ("P8, 1:1", "Impella"),
    ("P7/purge flow 10.6", "Impella"),
    ("P2", "Impella"),
    ("P-8", "Impella"),
    ("IABP", "IABP"),
    ("iabp", "IABP"),
    ("Impella, IABP", "IABP"),
    ("01:01", "IABP"),
    ("1 to 1", "IABP"),
    ("P8, 1:1", "IABP"),
    ("Thoratec HeartMate II,  Software Version 4.16", "LVAD"),
    ("Heartmate II ", "LVAD"),
    ("Fixed mode spped 8600-9000", "LVAD"),
    ("Fixed mode", "LVAD"),
    ("Fixed", "LVAD"),
    ("Thoratech", "VAD"),
    ("Yes", "VAD"),
)

MCS_DIAGNOSIS = (
    ("cardiovascular|cardiac surgery|s/p LVAD", "LVAD"),
    ("cardiovascular|cardiac surgery|s/p RVAD", "RVAD"),
    ("cardiovascular|cardiac surgery|s/p BIVAD", "BIVAD"),
    ("surgery|cardiac surgery|low cardiac output state|IABP", "IABP"),
)

# --- Dialysis -----------------------------------------------------------------------

DIALYSIS_TREATMENT = (
    ("renal|dialysis|ultrafiltration (fluid removal only)", "unknown_SCUF"),
    ("renal|dialysis|ultrafiltration (fluid removal only)|emergent", "acute_SCUF"),
    ("renal|dialysis|ultrafiltration (fluid removal only)|for acute renal failure", "acute_SCUF"),
    ("renal|dialysis|ultrafiltration (fluid removal only)|for chronic renal failure", "chronic_SCUF"),
    ("renal|dialysis|SLED", "SLED"),
    ("renal|dialysis|C V V H", "CVVH"),
    ("renal|dialysis|C A V H D", "CAVHD"),
    ("renal|dialysis|C V V H D", "CVVHD"),
    ("renal|dialysis|hemodialysis", "unknown_intermittent_hemodialysis"),
    ("renal|dialysis|hemodialysis|emergent", "acute_intermittent_hemodialysis"),
    ("renal|dialysis|hemodialysis|for acute renal failure", "acute_intermittent_hemodialysis"),
    ("renal|dialysis|hemodialysis|for chronic renal failure", "chronic_intermittent_hemodialysis"),
    ("toxicology|drug overdose|drug removal measures|hemodialysis", "toxicology_intermittent_hemodialysis"),
    ("renal|dialysis|peritoneal dialysis", "unknown_peritoneal dialysis"),
    ("renal|dialysis|peritoneal dialysis|emergent", "acute_peritoneal dialysis"),
    ("renal|dialysis|peritoneal dialysis|for chronic renal failure", "chronic_peritoneal dialysis"),
    ("renal|dialysis|peritoneal dialysis|for acute renal failure", "acute_peritoneal dialysis"),
    ("renal|dialysis|peritoneal dialysis|with cannula placement", "unknown_peritoneal dialysis"),
    ("renal|dialysis|arteriovenous shunt for renal dialysis", "av_shunt"),
    ("cardiovascular|vascular surgery|dialysis access surgery", "av_fistula"),
    ("renal|dialysis|insertion of venous catheter for hemodialysis", "hemodialysis_catheter"),
    ("renal|dialysis|insertion of venous catheter for hemodialysis|tunneled catheter", "hemodialysis_catheter"),
    ("renal|dialysis|insertion of venous catheter for hemodialysis|percutaneous catheter", "hemodialysis_catheter"),
    ("renal|procedures/radiology|arteriovenous shunt for renal dialysis", "av_shunt"),
    ("renal|procedures/radiology|insertion of catheter for peritoneal dialysis", "peritoneal_catheter"),
    ("renal|procedures/radiology|insertion of venous catheter for hemodialysis", "hemodialysis_catheter"),
    ("renal|procedures/radiology|insertion of venous catheter for hemodialysis|tunneled catheter", "hemodialysis_catheter"),
    ("renal|procedures/radiology|insertion of venous catheter for hemodialysis|percutaneous catheter", "hemodialysis_catheter"),
    ("endocrine|electrolyte correction|treatment of hyperkalemia|dialysis", "dialysis_electrolytes"),
    ("renal|electrolyte correction|treatment of hyperkalemia|dialysis", "dialysis_electrolytes"),
    ("renal|electrolyte correction|treatment of hyperphosphatemia|dialysis", "dialysis_electrolytes"),
)

DIALYSIS_ASSESSMENT_CELL = (("AV Fistula", "av_fistula"),)

# The second string is an event without a type.
DIALYSIS_DIAGNOSIS = (
    ("cardiovascular|post vascular surgery|s/p dialysis access surgery", "av_fistula"),
    ("renal|disorder of kidney|acute renal failure|unstable during hemodialysis", None),
)

DIALYSIS_PAST_HISTORY = (
    (
        "notes/Progress Notes/Past History/Organ Systems/Renal  (R)/Renal Failure/renal failure - hemodialysis",
        "past_hemodialysis",
    ),
    (
        "notes/Progress Notes/Past History/Organ Systems/Renal  (R)/Renal Failure/renal failure - peritoneal dialysis",
        "past_peritoneal_dialysis",
    ),
)

DIALYSIS_ADMISSION = (
    (
        "admission diagnosis|All Diagnosis|Operative|Diagnosis|Cardiovascular|Graft for dialysis, insertion of",
        "dialysis_graft",
    ),
)

DIALYSIS_OUTPUT = "dialysis_output"

# --- Which dialysis types count in staging --------------------------------------------

# Two of the peritoneal names below are spelled unlike the event labels above, so
# peritoneal events count only after label normalisation (see plans/stages.py).
CHRONIC_TYPES = (
    "chronic_SCUF",
    "chronic_intermittent_hemodialysis",
    "chronic_peritoneal_dialysis",
    "past_hemodialysis",
    "past peritoneal dialysis",
    "dialysis_graft",
    "av_fistula",
    "av_shunt",
)

ACUTE_TYPES = (
    "acute_SCUF",
    "SLED",
    "CVVH",
    "CAVHD",
    "CVVHD",
    "acute_intermittent_hemodialysis",
    "acute_peritoneal_dialysis",
)

UNKNOWN_TYPES = (
    "unknown_SCUF",
    "unknown_intermittent_hemodialysis",
    "unknown_peritoneal_dialysis",
)

# --- Body weight ----------------------------------------------------------------------

EXAM_WEIGHT_CURRENT = (
    "notes/Progress Notes/Physical Exam/Physical Exam/Constitutional/Weight and I&O/Weight (kg)/Current"
)
EXAM_WEIGHT_ADMISSION = (
    "notes/Progress Notes/Physical Exam/Physical Exam/Constitutional/Weight and I&O/Weight (kg)/Admission"
)

# Compared in upper case.
WEIGHT_CELL_KG = "BODYWEIGHT (KG)"
WEIGHT_CELL_LB = "BODYWEIGHT (LB)"
KILOGRAMS_PER_POUND = 0.45359237

# --- Urine ----------------------------------------------------------------------------

OUTPUT_PREFIX = "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|"

URINE_FOLEY_PREFIX = "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|foley"
# Looked for anywhere in the lower-cased path of a foley cell; any hit rules it out.
URINE_FOLEY_EXCLUDED = ("pacu", "or", "ir")

URINE_PATTERNS = (
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Output%Urinary Catheter%",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Output%Urethral Catheter%",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Urine Output (mL)%",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Output%External Urethral%",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Urinary Catheter Output%",
)

URINE_PATHS = (
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Urine",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|3 way foley",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|3 Way Foley",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Actual Urine",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Adjusted total UO NOC end shift",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|BRP (urine)",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|BRP (Urine)",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|condome cath urine",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|diaper urine",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|inc of urine",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|incontient urine",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Incontient urine",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Incontient Urine",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|incontinence of urine",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Incontinence-urine",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|incontinence/ voids urine",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|incontinent of urine",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|INCONTINENT OF URINE",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Incontinent UOP",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|incontinent urine",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Incontinent (urine)",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Incontinent Urine",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|incontinent urine counts",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|incont of urine",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|incont. of urine",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|incont. of urine count",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|incont urine",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|incont. urine",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Incont. urine",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Incont. Urine",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|inc urine",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|inc. urine",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Inc. urine",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Inc Urine",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|indwelling foley",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Indwelling Foley",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Straight Catheter-Foley",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Straight Catheterization Urine",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Straight Cath UOP",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|straight cath urine",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Straight Cath Urine",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|strait cath Urine",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Suprapubic Urine Output",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|true urine",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|True Urine",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|True Urine out",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|unmeasured urine",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Unmeasured Urine",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|unmeasured urine output",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Urethal Catheter",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Urethral Catheter",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|urinary output 7AM - 7 PM",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|urinary output 7AM-7PM",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|urine",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|URINE",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|URINE CATHETER",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Intermittent/Straight Cath (mL)",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|straightcath",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|straight cath",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Straight cath",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Straight  cath",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Straight Cath",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Straight  Cath",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Urine Output-LEFT PCN TUBE",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Urine Output-L Nephrostomy",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Urine Output-L Nephrostomy Tube",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Urine Output-Nephrostomy",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Urine Output-right nephrostomy",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Urine Output-RIGHT Nephrouretero Stent Urine Output",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Urine Output-R nephrostomy",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Urine Output-R Nephrostomy",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Urine Output-R. Nephrostomy",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Urine Output-R Nephrostomy Tube",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Urine Output-Rt Nephrectomy",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Urine Output-stent",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Urine Output-straight cath",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Urine Output-suprapubic",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Urine Output-Texas Cath",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Urine Output-Urine",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Urine Output-Urine Output",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Urine, R neph:",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Urine-straight cath",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Urine Straight Cath",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|urine (void)",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Urine- void",
    "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Urine, void:",
)
