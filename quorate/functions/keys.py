"""Deterministic keys."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the namespace of entity keys.
NAMESPACE = uuid.UUID("fb5218eb-4b38-5c1f-9c4e-b798e8616f9a")


def uuid5(text: Column, namespace: uuid.UUID = NAMESPACE) -> Column:
    """RFC 4122 version 5 UUID of a string, from SHA-1 alone; null stays null."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), F.encode(text, "UTF-8")))
    variant = F.substring(F.lit("89ab89ab89ab89ab"), F.conv(F.substring(digest, 17, 1), 16, 10).cast("int") + 1, F.lit(1))
    return F.concat(
        F.substring(digest, 1, 8), F.lit("-"), F.substring(digest, 9, 4), F.lit("-5"), F.substring(digest, 14, 3), F.lit("-"), variant, F.substring(digest, 18, 3), F.lit("-"), F.substring(digest, 21, 12)
    )


def entity_key(kingdom: Column, rank: Column, name: Column, author: Column, year: Column) -> Column:
    """The key's input; null parts are skipped."""
    return F.lower(F.concat_ws(":", kingdom, rank, F.replace(name, F.lit(" "), F.lit(".")), author, year.cast("string")))
