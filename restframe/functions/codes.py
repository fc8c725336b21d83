"""Status-code rules: code-set expressions, lookup classes, sink error predicate."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The range of codes a rule may name.
MIN_CODE = 100
MAX_CODE = 599

SUCCESS = "SUCCESS"
RETRY = "RETRY"
IGNORED = "IGNORED"
ERROR = "ERROR"

_GROUP = r"[1-5][xX]{2}"
_NUMBER = r"[+]?[0-9]+"


def parse_code_set(expression: str | None) -> frozenset[int]:
    """The codes named by an expression such as ``2XX,404,!203`` (one fixed rule)."""
    included: set[int] = set()
    excluded: set[int] = set()
    for token in (part.strip() for part in (expression or "").split(",")):
        if not token:
            continue
        negated = token.startswith("!")
        name = token[1:] if negated else token
        if not negated and re.fullmatch(_GROUP, name):
            first = int(name[0]) * 100
            included.update(range(first, first + 100))
        elif re.fullmatch(_NUMBER, name) and MIN_CODE <= int(name) <= MAX_CODE:
            (excluded if negated else included).add(int(name))
        else:
            raise ValueError(f"cannot read status code {token!r} in {expression!r}")
    return frozenset(included - excluded)


def _tokens(expression: Column) -> Column:
    trimmed = F.transform(
        F.split(F.coalesce(expression, F.lit("")), ","),
        lambda t: F.regexp_replace(t, r"^\s+|\s+$", ""),
    )
    return F.filter(trimmed, lambda t: t != "")


def _code(token: Column) -> Column:
    """A plain code as an int, null when it is not one."""
    # Without leading zeros, so that a code of any length can be read.
    digits = F.regexp_replace(token, "^[+]?0*(?=[0-9])", "")
    number = F.when(token.rlike(f"^{_NUMBER}$"), digits.try_cast("int"))
    return F.when(number.between(MIN_CODE, MAX_CODE), number)


def code_set(expression: Column) -> Column:
    """``parse_code_set`` for a column of rules: sorted ``array<int>``, null when invalid."""
    tokens = _tokens(expression)
    included = F.flatten(
        F.transform(
            F.filter(tokens, lambda t: ~t.startswith("!")),
            lambda t: F.when(
                t.rlike(f"^{_GROUP}$"),
                F.sequence(
                    F.substring(t, 1, 1).try_cast("int") * 100,
                    F.substring(t, 1, 1).try_cast("int") * 100 + 99,
                ),
            ).otherwise(F.array(_code(t))),
        )
    )
    excluded = F.transform(
        F.filter(tokens, lambda t: t.startswith("!")),
        lambda t: _code(t.substr(F.lit(2), F.length(t))),
    )
    valid = ~F.exists(F.concat(included, excluded), lambda c: c.isNull())
    return F.when(valid, F.array_sort(F.array_except(included, excluded)))


def rule_error(success: Column, retry: Column) -> Column:
    """Why a (success, retry) pair of code sets is unusable; null when it is fine."""
    return (
        F.when(success.isNull() | retry.isNull(), F.lit("invalid code expression"))
        .when(F.size(success) == 0, F.lit("empty success codes"))
        .when(F.arrays_overlap(success, retry), F.lit("success and retry codes overlap"))
    )


def check_rules(success: frozenset[int], retry: frozenset[int]) -> None:
    if not success:
        raise ValueError("the success codes must not be empty")
    if success & retry:
        raise ValueError(f"codes {sorted(success & retry)} are both success and retry codes")


def status_in(status: Column, codes: Iterable[int]) -> Column:
    """Membership as a few range tests, which keeps the generated code small."""
    test = F.lit(False)
    run: list[int] = []
    for code in [*sorted(codes), None]:
        if run and (code is None or code != run[-1] + 1):
            test = test | status.between(run[0], run[-1])
            run = []
        if code is not None:
            run.append(code)
    return F.coalesce(test, F.lit(False))


def classify(
    status: Column, success: Iterable[int], retry: Iterable[int], ignored: Iterable[int] = ()
) -> Column:
    """SUCCESS / IGNORED / RETRY / ERROR for one fixed rule set."""
    return (
        F.when(status_in(status, ignored), IGNORED)
        .when(status_in(status, success), SUCCESS)
        .when(status_in(status, retry), RETRY)
        .otherwise(ERROR)
    )


def parse_sink_codes(error_codes: str = "", exclude: str = "") -> tuple[set[int], set[int], set[int]]:
    """(status classes, single codes, excluded codes) of the sink error options."""
    classes: set[int] = set()
    singles: set[int] = set()
    for token in (part.strip().upper() for part in (error_codes or "").split(",")):
        if not token:
            continue
        if len(token) != 3:
            raise ValueError(f"a status code has three characters, got {token!r}")
        if token.endswith("XX"):
            if token[0] not in "12345":
                raise ValueError(f"unknown status class {token!r}")
            classes.add(int(token[0]))
        else:
            singles.add(int(token))
    if not classes and not singles:
        classes = {4, 5}
    excluded = {int(part) for part in (exclude or "").split(",") if part.strip()}
    return classes, singles, excluded


def is_sink_error(status: Column, error_codes: str = "", exclude: str = "") -> Column:
    """True when a delivery status counts as failed; a status below 100 is rejected."""
    classes, singles, excluded = parse_sink_codes(error_codes, exclude)
    family = F.floor(status / 100).cast("int")
    hit = family.isin(sorted(classes)) if classes else F.lit(False)
    if singles:
        hit = hit | status.isin(sorted(singles))
    if excluded:
        hit = hit & ~status.isin(sorted(excluded))
    return F.when(
        status < MIN_CODE,
        F.raise_error(F.concat(F.lit("invalid HTTP status "), status.cast("string"))).cast("boolean"),
    ).otherwise(hit)
