"""Judge-output parsing as Column expressions.

The judge returns text that should be a JSON object with integer scores. It
is parsed with ``try_parse_json`` into a VARIANT so a *missing* key (default
score) can be told apart from a JSON ``null`` (score 1). Anything that is not
a JSON object behaves like an empty object. VARIANT values never leave this
module: the result is a plain struct.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Score range, defaults for absent keys, default explanation.
SCORE_LO, SCORE_HI = 1, 5
SCORE_DEFAULTS = {"relevance": 3, "helpfulness": 3, "tone": 4}
DEFAULT_EXPLANATION = "No explanation provided."


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def coerce_score(value: Column, lo: int = SCORE_LO, hi: int = SCORE_HI) -> Column:
    """L4: integer conversion like ``int(x)`` (truncating numbers, digit strings
    only) of any size, then clamp to [lo, hi]; failure -> ``lo``. ``value`` is a
    VARIANT. Numbers beyond bigint are clamped by their sign."""
    small = F.try_variant_get(value, "$", "bigint")
    text = F.try_variant_get(value, "$", "string")
    kind = F.schema_of_variant(value)
    number = F.when(kind.isin("DOUBLE", "FLOAT") | kind.startswith("DECIMAL"),
                    F.try_variant_get(value, "$", "double"))
    digits = F.when((kind == "STRING") & F.regexp(text, F.lit(r"^\s*[+-]?[0-9]+\s*$")),
                    F.trim(text).try_cast("double"))
    large = F.coalesce(number, digits)  # only its side of the range matters
    clamped = F.when(large >= hi, hi).when(large <= lo, lo)
    inside = F.when(small.isNotNull(), F.greatest(F.lit(lo), F.least(F.lit(hi), small)))
    return F.coalesce(inside, clamped, F.lit(lo)).cast("int")


def parse_judge(raw) -> Column:
    """Raw judge text -> struct(relevance, helpfulness, tone, explanation)."""
    v = F.try_parse_json(_col(raw))
    fields = []
    for key, default in SCORE_DEFAULTS.items():
        node = F.try_variant_get(v, f"$.{key}", "variant")
        fields.append(F.when(node.isNull(), F.lit(default))
                      .otherwise(coerce_score(node)).alias(key))
    expl = F.try_variant_get(v, "$.explanation", "string")
    node = F.try_variant_get(v, "$.explanation", "variant")
    number = F.try_variant_get(node, "$", "double")
    kind = F.schema_of_variant(node)
    # an absent, empty, false or zero value of any type counts as none
    text = F.coalesce(kind == "STRING", F.lit(False))
    none = F.when(text, expl == "").otherwise(
        F.coalesce(expl, F.lit("")).isin("", "false", "[]", "{}") | F.coalesce(number == 0, F.lit(False)))
    fields.append(F.when(none, F.lit(DEFAULT_EXPLANATION)).otherwise(expl).alias("explanation"))
    return F.struct(*fields)
