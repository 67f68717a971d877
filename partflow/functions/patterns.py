"""Fixed values that must equal the reference's for identical results.
"""

# --- fixed values -----------------------------------------------------------------
DESCRIPTION_EXCLUDE = "scrap|return|inspection|labor|freight|black|replace|maintenance|reweld|re-weld|bit ball|screw|bit|balls|set"  # noqa: E501
PART_EXCLUDE = "scrap|return|inspection|labor|freight|black|replace|balls|bit ball|set|screw|rw|skim"
MOLD_BLANK_MARKERS = ("BK", "KM", "BM", "BNK", "BVM", "JM", "XM")
X_RACE_MARKERS = ("15X", "16X", "15EX", "16EX")
RELATIVE_DROP_CATEGORIES = ("Compression Tools", "Jaw Clutch Center", "Adjustable Bent Housings")
DENOMINATOR_CATEGORY = "Mandrels"
EXCLUDED_CATEGORY = "none"
BOM_ROOT = "Root"
TREE_CSV_HEADER = ("Node", "Parent", "Depth", "Description", "Quantity")
TREE_ROOT_PARENT = "ROOT"
TREE_ROOT_DESCRIPTION = "N/A"
TIME_UNIT_DIVISORS = {"M": 60.0, "S": 3600.0}
PAGE_SIZE = 200
LOOKUP_BATCH = 300
# ------------------------------------------------------------------------------------

# Parameters whose reference literals were site specific; defaults follow the test data.
HOUSE_ACCOUNT = "HOUSEDH"          # open orders of this customer are in-house work
HOUSE_PATTERN = "HOUSE"            # clean_sales drops customers containing this text
GROUP_NAMES = ("ALPHA", "DELTA", "OMEGA")
BASELINE_GROUP = "ALPHA"
