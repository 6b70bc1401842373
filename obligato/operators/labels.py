"""Ordered rule labels: the first rule that matches gives the label."""

from pyspark.sql import Column, functions as F

from obligato.functions.text import matches


def first_match(text: Column, rules: list[tuple[str, str, bool]], overridden: Column) -> Column:
    """``rules`` are (label, pattern, override applies); no match gives NULL."""
    label = F.lit(None).cast("string")
    for name, pattern, override in reversed(rules):
        hit = matches(text, pattern)
        if override:
            hit = hit & ~overridden
        label = F.when(hit, F.lit(name)).otherwise(label)
    return label
