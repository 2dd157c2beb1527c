"""Fields of payloads whose form varies by record, read as VARIANT."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_variant(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Add the JSON text as VARIANT column ``v``, parsed once per row; text that is no JSON fails.

    The outer generator keeps filters on fields from parsing the text again.
    """
    return df.select("*", F.explode_outer(F.array(F.parse_json(payload))).alias("v"))


def first_value(paths: Sequence[str], kind: str = "string", v: str = "v") -> Column:
    """The first value of the kind that a record holds at one of the paths, else NULL.

    A value that can't be cast to the kind, and an object or array where text is asked for, is
    passed over for the next path, and so is a JSON null.
    """
    if kind != "string":
        return F.coalesce(*[F.try_variant_get(v, p, kind) for p in paths])
    found = []
    for path in paths:
        form = F.schema_of_variant(F.try_variant_get(v, path, "variant"))
        nested = F.coalesce(form.startswith("OBJECT") | form.startswith("ARRAY"), F.lit(False))
        found.append(F.when(~nested, F.try_variant_get(v, path, "string")))
    return F.coalesce(*found)
