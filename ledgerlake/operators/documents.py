"""Raw block documents parsed once into one nested table.

``block`` holds all fields of a document but the call trees, ``trees`` the call
trees as JSON text. Kept as Parquet, every parser of ``operators.parse`` and the
call walker read the nested columns they need from it and no raw text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake import schemas as S
from ledgerlake.operators.calls import TREES, call_trees
from ledgerlake.operators.parse import EVENT


def parse_documents(source: DataFrame) -> DataFrame:
    """The event columns of the envelope, ``block`` and ``trees``; row by row, no shuffle.

    Trees are parsed apart from the rest: one too deep for the JSON reader takes
    the place of its own columns only.
    """
    block = F.from_json("info", S.whole_block(), S.JSON_OPTIONS)
    parsed = source.select(*EVENT, block.alias("block"), F.from_json("info", *TREES).alias("_trees"))
    return parsed.select(*EVENT, "block", call_trees(F.col("_trees")).alias("trees"))
