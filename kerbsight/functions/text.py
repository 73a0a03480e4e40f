"""Text expressions: addresses, permit keywords, names of images, repaired coordinates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What an object of a permit is called, by class.
KEYWORDS = {2: ("puinbak", "container", "keet", "cabin"), 3: ("toilet", "dixi"), 4: ("steiger",)}


def address(c: Column) -> dict[str, Column]:
    """Street, number, addition and postcode of an address; all null where it isn't one.

    The postcode is looked for first: four digits and two letters, in any case and spacing, that have a house number right
    before them, whatever follows. The house number is the first number with a space in front behind which, up to the
    postcode, only one run of letters, figures, strokes and dashes comes, its addition; what is before it is the street.
    """
    codes = F.regexp_extract_all(c, F.lit(r"\s\d{4}\s*[A-Za-z]{2}(?=\s|$)"), F.lit(0))
    head = lambda code: F.regexp_replace(F.substring(c, F.lit(1), F.position(code, c) - 1), r"[\s,]+$", "")
    code = F.get(F.filter(codes, lambda k: head(k).rlike(r"\S\s+\d+\s*[A-Za-z0-9/-]*$")), F.lit(0))
    before = head(code)
    house = F.regexp_extract(before, r"\s(\d+\s*[A-Za-z0-9/-]*)$", 1)
    street = F.trim(F.substring(before, F.lit(1), F.length(before) - F.length(house)))
    number = F.regexp_extract(house, r"^\d+", 0)
    addition = F.trim(F.substring(house, F.length(number) + 1, F.length(house)))
    return {"street": street, "number": number.try_cast("int"), "addition": addition, "postcode": F.upper(F.regexp_replace(code, r"\s", ""))}


def object_names(c: Column) -> Column:
    """The ``object`` texts of a JSON array; empty for null, malformed or other JSON."""
    parsed = F.from_json(c, "array<struct<object:string>>")
    return F.coalesce(F.transform(F.filter(parsed, lambda x: x["object"].isNotNull()), lambda x: x["object"]), F.array().cast("array<string>"))


def classes_of(names: Column, keywords: dict[int, tuple[str, ...]] = KEYWORDS) -> Column:
    """Classes any of whose keywords is in any of the names, upper or lower case, in the order of the classes."""
    hit = lambda k: F.exists(names, lambda n: n.rlike("(?i)(" + "|".join(keywords[k]) + ")"))
    return F.filter(F.array(*[F.when(hit(k), F.lit(k)) for k in keywords]), lambda x: x.isNotNull())


def basename(c: Column) -> Column:
    """File name of a path or url, without a query string."""
    return F.substring_index(F.substring_index(c, "?", 1), "/", -1)


def stem(c: Column) -> Column:
    return F.regexp_replace(c, r"\.[^./]*$", "")


def source_and_number(c: Column) -> tuple[Column, Column]:
    """``source_0042.jpg``: what stands before the last underscore, and the number after it."""
    pattern = r"^(.*)_(\d+)\.[^.]*$"
    return F.nullif(F.regexp_extract(c, pattern, 1), F.lit("")), F.regexp_extract(c, pattern, 2).try_cast("int")


def repaired(c: Column) -> Column:
    """A coordinate of whose points only the first one counts, as a number; null where it can't be one."""
    at = F.instr(c, ".")
    return F.when(at == 0, c).otherwise(F.concat(F.substring(c, F.lit(1), at), F.replace(F.substring(c, at + 1, F.length(c)), F.lit("."), F.lit("")))).try_cast("double")


def upload_place(path: Column) -> tuple[Column, Column]:
    """Folder and file name of an image below a job's input folder ``INPUT_...``; without one, of its own folder."""
    inside = F.regexp_extract(path, r"^.*?/INPUT_[^/]*/(?:(.*)/)?[^/]*$", 1)
    own = F.element_at(F.split(path, "/"), -2)
    return F.when(path.contains("/INPUT_"), inside).otherwise(own), F.element_at(F.split(path, "/"), -1)


def day_folder(day: Column) -> Column:
    """Name of a day's folder."""
    return F.date_format(day, "yyyy-MM-dd")


def label_line(k: Column, *values: Column) -> Column:
    """One line of a label file: class and numbers with six decimals."""
    return F.format_string("%d " + " ".join(["%.6f"] * len(values)), k, *values)


def share_a_class(a: Column, b: Column, sep: str = ";") -> Column:
    """Whether two lists in text have a member in common; empty ones have none."""
    members = lambda c: F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), sep), lambda x: F.trim(x)), lambda x: x != "")
    return F.coalesce(F.arrays_overlap(members(a), members(b)), F.lit(False))


def epoch_time(seconds: Column) -> Column:
    """A time from seconds since 1970, with their fractions."""
    return F.timestamp_micros((seconds * 1_000_000).cast("long"))


def whole_seconds(time: Column) -> Column:
    """A time, or ISO text, without fractions of a second; null where it can't be read."""
    return F.date_trunc("second", F.try_to_timestamp(time.cast("string")))
