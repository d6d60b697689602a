"""Names, keywords, formats and defaults that results depend on."""

# --- fixed values -----------------------------------------------------------
# The mis-decoded character and the one it stands for.
MISREAD_CHAR = "ԥ"
CORRECT_CHAR = "豫"

# A plate column is the first whose lower-cased name holds one of these.
PLATE_KEYWORDS = ("车牌", "plate", "号牌")

# The date column to tidy is the first whose name holds one of these, case kept.
TIDY_DATE_KEYWORDS = ("日期", "date", "Date", "DATE")

# Columns searched for a file's date; the lower-cased name holds one of these.
CONTENT_DATE_KEYWORDS = ("时间", "date", "日期")

# Mileage column: the first of these that is present, in this order.
MILEAGE_COLUMNS = ("总里程(公里)", "总里程", "mileage", "total_mileage")

# A summary cell holds both markers: 2025/1/1 0:00:00---2025/1/1 0:00:00合计:
SUMMARY_RANGE_MARK = "---"
SUMMARY_TOTAL_MARK = "合计"

# Header of a plate list; text that must not be read as a plate.
LIST_HEADER = "车牌号"
NOT_A_PLATE = ("", "nan")

# Cell texts a list reader takes for a missing value.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Calendar columns and their filler.
CALENDAR_PLATE = "车号"
CALENDAR_DAY = "日期"
CALENDAR_EXTRA_PLATE = "补充车辆"
CALENDAR_EXTRA_DAY = "补充日期"
FILLER_PLATE = "豫ND7570"
FILLER_DAY = "2025/1/1"
CALENDAR_END = "2025-06-30"

# Bands as min,max,label.
DEFAULT_BANDS = ("0,30,low", "45,85,medium")

# Year taken for MMDD_* names.
DEFAULT_NAME_YEAR = 2024

# Names of temporary or system files start with one of these.
TEMP_FILE_PREFIXES = ("~$", ".", "#")

# Suffixes of output names.
PROCESSED_SUFFIX = "_processed"
MERGED_SUFFIX = "_merged"
SHUFFLED_SUFFIX = "_shuffled"
PROCESSED_DIR_SUFFIX = "_处理后"

# Columns kept when tidying, columns on each side of a paired table, base seed.
KEEP_COLUMNS = 5
PAIR_SIDE_COLUMNS = 5
BASE_SEED = 42
# ----------------------------------------------------------------------------
