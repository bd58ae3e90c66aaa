"""Declared schemas. Nothing is inferred."""

from pyspark.sql import types as T


def strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


# Raw record tables as extraction writes them. The header texts are a file format.
RAW_PLAYERS = strings(
    "College", "Name", "Jersey", "Position", "Class Year", "Height", "Weight", "B/T", "High School", "Hometown"
).add("Season", T.IntegerType())
RAW_COACHES = strings("College", "Name", "Title").add("Season", T.IntegerType())
NAMES = strings("name")

# Seed dimensions.
TEAMS = strings("college", "member of", "team")
CONFERENCES = strings("name", "region", "abbreviation", "founded year", "number of teams", "headquarters")

# Raw page table.
PAGES = strings("college", "url").add("season", T.IntegerType()).add("html", T.StringType())

# Position of a record in the load order: batch, page within it, card within that.
SEQ = "struct<batch_no:int,page_no:int,card_no:int>"
