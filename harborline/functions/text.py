"""Text normalisation shared by cleaning and matching, as SQL expressions."""

from __future__ import annotations

# Fixed value: what counts as a reachable e-mail address.  \z instead of $,
# because $ also matches before a final line break on the JVM.
EMAIL_PATTERN = r"^[^@\\s]+@[^@\\s]+\\.[A-Za-z]{2,}\\z"
# Fixed values of reference matching.
REF_PREFIX = "^GW-"
MAX_REF_EDITS = 4


def tidy_lower(c: str) -> str:
    return f"LOWER(TRIM({c}))"


def tidy_upper(c: str) -> str:
    return f"UPPER(TRIM({c}))"


def payment_ref(c: str) -> str:
    """Payment reference without case, padding and gateway prefix."""
    return f"REGEXP_REPLACE({tidy_upper(c)}, '{REF_PREFIX}', '')"


def refs_look_related(left: str, right: str) -> str:
    """One reference contains the other, or a few edits apart.

    levenshtein with a threshold stops early and answers -1 beyond it.
    """
    return (
        f"(CONTAINS({left}, {right}) OR CONTAINS({right}, {left}) "
        f"OR LEVENSHTEIN({left}, {right}, {MAX_REF_EDITS}) BETWEEN 0 AND {MAX_REF_EDITS})"
    )


def alnum_key(c: str) -> str:
    """Lower-case letters and digits only; the fallback campaign identity."""
    return f"REGEXP_REPLACE(LOWER({c}), '[^a-z0-9]', '')"


def one_of(c: str, values) -> str:
    return f"{c} IN ({', '.join(quote(v) for v in values)})"


def quote(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"
