"""Category normalisation (C1) and taxonomy (C4) as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sub-category substring rules, first hit wins.
CATEGORY_RULES = (
    (("refund",), "REFUND"),
    (("cancel",), "CANCEL"),
    (("ship", "delivery"), "SHIPPING"),
    (("account", "password"), "ACCOUNT"),
)
# The configured top-category taxonomy.
TOP_CATEGORIES = ("ORDER", "SHIPPING", "ACCOUNT", "REFUND", "CANCEL")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_category(category, sub_category) -> Column:
    """Rules on lower(sub_category); else upper(category); else OTHER.

    Missing values (NULL or an absent column passed as ``F.lit(None)``) count
    as empty text (Q10).
    """
    sub = F.lower(F.coalesce(_col(sub_category).cast("string"), F.lit("")))
    cat = F.upper(F.coalesce(_col(category).cast("string"), F.lit("")))
    out = None
    for words, label in CATEGORY_RULES:
        cond = None
        for w in words:
            c = F.contains(sub, F.lit(w))
            cond = c if cond is None else (cond | c)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.when(cat != "", cat).otherwise(F.lit("OTHER")))


def in_taxonomy(label, taxonomy=TOP_CATEGORIES) -> Column:
    """C4: whether a (model) label is one of the configured categories."""
    return _col(label).isin(list(taxonomy))


def add_normalized_category(df, category: str = "category", sub_category: str = "Sub Category",
                            out: str = "normalized_category"):
    """Add ``out``; a column absent from ``df`` counts as missing (plan-time check)."""
    def pick(name):
        return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast("string")
    return df.withColumn(out, normalize_category(pick(category), pick(sub_category)))
