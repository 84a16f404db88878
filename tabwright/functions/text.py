"""Text tests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabwright.functions.numbers import col_of

# What a policy-conforming text must hold at least one of.
POLICY_CLASSES = {
    "lowercase": r"[a-z]",
    "uppercase": r"[A-Z]",
    "digit": r"\p{Nd}",
    "symbol": r"[!@#$%^&*()_+\-=\[\]{};:'\",.<>/?\\|`~]",
}


def is_blank(c: str | Column) -> Column:
    """Missing, empty or only white space."""
    return F.coalesce(F.length(F.regexp_replace(col_of(c), r"^\s+", "")) == 0, F.lit(True))


def policy_rules(c: str | Column) -> dict[str, Column]:
    """One test per character class, plus: no newline except one at the very end."""
    text = F.coalesce(col_of(c), F.lit(""))
    rules = {name: text.rlike(pattern) for name, pattern in POLICY_CLASSES.items()}
    rules["single_line"] = ~F.regexp_replace(text, r"\n\z", "").contains("\n")
    return rules


def follows_policy(c: str | Column) -> Column:
    verdict = F.lit(True)
    for test in policy_rules(c).values():
        verdict = verdict & test
    return verdict
