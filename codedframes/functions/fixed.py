"""Values that are fixed by the file formats and by documented defaults."""

from __future__ import annotations

# Cell texts that mean "missing" (documented pandas defaults).
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Dictionary types that hold coded categories.
CATEGORICAL_TYPES = ("Categorical (single)", "Categorical (multiple)")

# Limits, charset and file layout defaults.
MAX_CATEGORIES = 256
CHARSET = "windows-1252"
CODING_FILE_SKIP_LINES = 7
BAD_DOWNLOAD_TEXT = "Sorry, internal error prevents download of coding"
PLACEHOLDER = "Empty column {}"

# Source type -> target, profile "dtype".
DTYPE_TARGETS = {
    "Type": {
        "Sequence": "int",
        "Integer": "float",
        "Continuous": "float",
        "Text": "string",
        "Date": ("Date", "%Y-%m-%d"),
        "Time": ("Date", "%Y-%m-%d %H:%M:%S"),
        "Compound": "string",
        "Curve": "string",
    },
    "Encoding_type": {
        "Integer": "float",
        "Real": "float",
        "ERROR": ("Date", "%Y-%m-%d"),
        "String": "string",
    },
}

# Source type -> target, profile "nullable". Dates without a
# clock time are plain dates here, coded dates are timestamps.
NULLABLE_TARGETS = {
    "Type": {
        "Sequence": "long",
        "Integer": "long",
        "Continuous": "float",
        "Text": "string",
        "Date": ("Day", "%Y-%m-%d"),
        "Time": ("Date", "%Y-%m-%d %H:%M:%S"),
        "Compound": "string",
        "Curve": "string",
    },
    "Encoding_type": {
        "Integer": "long",
        "Real": "float",
        "ERROR": ("Date", "%Y-%m-%d"),
        "String": "string",
    },
}

# Target name -> Spark type. "int" is the only one that refuses
# missing values.
SPARK_TYPES = {
    "int": "bigint",
    "int64": "bigint",
    "long": "bigint",
    "Int64": "bigint",
    "float": "double",
    "float64": "double",
    "double": "double",
    "string": "string",
    "str": "string",
    "object": "string",
    "date": "timestamp_ntz",
    "day": "date",
}
REQUIRED_TARGETS = ("int", "int64")

# Strptime directive -> (fixed-width, free-width) Spark pattern.
STRPTIME_TO_SPARK = {
    "%Y": ("yyyy", "yyyy"),
    "%y": ("yy", "yy"),
    "%m": ("MM", "M"),
    "%d": ("dd", "d"),
    "%H": ("HH", "H"),
    "%M": ("mm", "m"),
    "%S": ("ss", "s"),
    "%b": ("MMM", "MMM"),
    "%j": ("DDD", "DDD"),
    "%f": ("SSSSSS", "SSSSSS"),
}

# Characters of windows-1252 at 0x80-0x9F, in byte order, with
# the five undefined bytes left out.
CP1252_BYTES = (
    "\x80\x82\x83\x84\x85\x86\x87\x88\x89\x8a\x8b\x8c\x8e"
    "\x91\x92\x93\x94\x95\x96\x97\x98\x99\x9a\x9b\x9c\x9e\x9f"
)
CP1252_TEXT = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
