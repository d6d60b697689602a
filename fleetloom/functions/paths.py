"""Parts of paths and names of outputs, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetloom import fixed


def plain_path(path: Column) -> Column:
    """A path as the file system names it, without the escapes of a file's metadata."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def glob_literal(path: str) -> str:
    """A path for Spark's readers, which would take some characters for patterns."""
    return "".join("\\" + c if c in "*?[]{}\\" else c for c in path)


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def parent(path: Column) -> Column:
    """Everything before the last slash; empty for a bare name."""
    return F.regexp_extract(path, r"(?s)^(.*)/[^/]*$", 1)


def extension(path: Column) -> Column:
    """The last dot and what follows, in the path's own case; empty without one."""
    return F.regexp_extract(file_name(path), r"(?s)^.+(\.[^.]+)$", 1)


def stem(path: Column) -> Column:
    """The file name without its extension."""
    name = file_name(path)
    return F.left(name, F.length(name) - F.length(extension(path)))


def is_csv(path: Column) -> Column:
    return F.lower(extension(path)) == ".csv"


def is_temporary(name: Column) -> Column:
    """True for the names of temporary and system files."""
    return F.substring(name, 1, 1).isin([p for p in fixed.TEMP_FILE_PREFIXES if len(p) == 1]) | F.startswith(
        name, F.lit(fixed.TEMP_FILE_PREFIXES[0])
    )


def pair_key(file_stem: Column, separator: str = "_") -> Column:
    """The stem up to the first separator; the whole stem without one."""
    return F.substring_index(file_stem, separator, 1)


def joined(directory: Column, name: Column) -> Column:
    return F.when(directory == "", name).otherwise(F.concat(directory, F.lit("/"), name))


def suffixed(path: Column, suffix: str) -> Column:
    """The file name with ``suffix`` between stem and extension."""
    return F.concat(stem(path), F.lit(suffix), extension(path))


def processed_name(path: Column) -> Column:
    return suffixed(path, fixed.PROCESSED_SUFFIX)


def band_name(path: Column, label: Column) -> Column:
    return F.concat(stem(path), F.lit("_"), label, extension(path))


def merged_name(key: Column, ext: str = ".parquet") -> Column:
    return F.concat(key, F.lit(fixed.MERGED_SUFFIX + ext))


def shuffled_name(path: Column) -> Column:
    return suffixed(path, fixed.SHUFFLED_SUFFIX)


def processed_dir(directory: str) -> str:
    """Name of the output directory beside ``directory``."""
    return directory.rstrip("/") + fixed.PROCESSED_DIR_SUFFIX
