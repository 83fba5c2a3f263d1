"""The person key: a salted SHA-256 over name and national id."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def person_hash(name: Column, ssn: Column, salt: Column, null_text: str | None = None) -> Column:
    """Upper-case hex SHA-256 of `name || ssn || salt` (UTF-8, no delimiter).

    A missing part gives a null key, unless `null_text` names the text that
    stands for a missing name or id before hashing.
    """
    if null_text is not None:
        name, ssn = (F.coalesce(part, F.lit(null_text)) for part in (name, ssn))
    return F.upper(F.sha2(F.concat(name, ssn, salt), 256))
