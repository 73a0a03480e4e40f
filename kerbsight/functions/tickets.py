"""Texts and nested payloads of tickets; null fields are left out of the JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: How classes are called in a ticket.
NAMES = {2: "container", 3: "mobile toilet", 4: "scaffolding"}


def class_name(c: Column) -> Column:
    return F.coalesce(F.create_map(*[F.lit(x) for kv in NAMES.items() for x in kv])[c], F.lit("object"))


def ticket_text(object_class: Column, day: Column, permit: Column, distance: Column) -> Column:
    """What was seen when, and the nearest permit if there is one."""
    seen = F.format_string("A %s was seen on %s.", class_name(object_class), F.date_format(day, "yyyy-MM-dd"))
    near = F.format_string(" The nearest permit is %s, at %.0f m.", permit, distance)
    return F.concat(seen, F.when(permit.isNull() | distance.isNull(), " There is no permit nearby.").otherwise(near))


def distance_note(permit: Column, bridge: Column) -> Column:
    """A note on how far the nearest permit and the nearest weak quay are; what isn't known is left out."""
    line = lambda what, c: F.when(c.isNotNull(), F.format_string(f"Distance to the nearest {what}: %.0f m", c))
    return F.array_join(F.filter(F.array(line("permit", permit), line("weak quay", bridge)), lambda x: x.isNotNull()), "\n")


#: What the notes of a ticket say if a caller gives no lines of its own; ``{}`` stands for the class's name.
TRIAGE = ("Look at the picture first; a ticket without a {} in it ends here.", "Keep the source of the ticket: it tells that no person reported it.")
INSPECTION = ("Is the {} in the picture of a kind that needs leave to stand there?", "Has its owner, or anyone at this place, such leave?", "If not, go on as with any other {}.")


def note(heading: str, object_class: Column, lines: tuple[str, ...]) -> Column:
    """A heading and numbered lines, in which ``{}`` is the name of the class."""
    text = "\n".join([f"{heading}:", *(f"{k}. {line}" for k, line in enumerate(lines, 1))])
    return F.replace(F.lit(text), F.lit("{}"), class_name(object_class))


def triage_note(object_class: Column, lines: tuple[str, ...] = TRIAGE, heading: str = "Sorting") -> Column:
    """What whoever sorts tickets has to do."""
    return note(heading, object_class, lines)


def inspection_note(object_class: Column, lines: tuple[str, ...] = INSPECTION, heading: str = "Inspection") -> Column:
    """What an inspector has to do."""
    return note(heading, object_class, lines)


def payload(text: Column, lat: Column, lon: Column, day: Column, district: Column | None = None) -> Column:
    """The nested JSON of a new ticket."""
    point = F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates"))
    place = F.struct(point.alias("geometry"), (district if district is not None else F.lit(None).cast("string")).alias("district"))
    return F.to_json(F.struct(text.alias("text"), place.alias("location"), F.date_format(day, "yyyy-MM-dd").alias("incident_date_start")))
