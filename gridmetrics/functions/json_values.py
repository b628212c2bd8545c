"""Type-strict reading of JSON scalars held as VARIANT, and text normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridmetrics.spec import ACCENTED, TRUE_WORDS, UNACCENTED

# The characters that Unicode counts as white space.
_WHITE = "".join(map(chr, (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
_NUMBER = r"^(?:TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL\(.*)"


def json_type(value: Column) -> Column:
    """JSON type name of a variant: ``STRING``, ``BOOLEAN``, ``VOID`` (null), a number..."""
    return F.schema_of_variant(value)


def is_number_type(type_name: Column) -> Column:
    """Whether a :func:`json_type` is numeric; NULL when the field is absent."""
    return type_name.rlike(_NUMBER)


def as_double(value: Column) -> Column:
    """Numeric content of a variant. Also converts strings and booleans: check the type."""
    return F.try_variant_get(value, "$", "double")


def text_or_null(value: Column) -> Column:
    """Content of a JSON string; NULL for every other JSON type."""
    return F.when(json_type(value) == "STRING", F.try_variant_get(value, "$", "string"))


def normalized(text: Column) -> Column:
    """Accents removed, outer white space trimmed, lower case."""
    plain = F.translate(text, ACCENTED, UNACCENTED)
    return F.lower(F.btrim(plain, F.lit(_WHITE)))


def flag_is_true(value: Column) -> Column:
    """Truthiness of a JSON flag in any encoding; never NULL.

    The JSON type decides: the string ``"2"`` is false while the number ``2`` is true.
    """
    kind = json_type(value)
    truth = (
        F.when(kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean"))
        .when(kind == "STRING", normalized(F.try_variant_get(value, "$", "string")).isin(*TRUE_WORDS))
        .when(is_number_type(kind), as_double(value) != 0)
    )
    return F.coalesce(truth, F.lit(False))
