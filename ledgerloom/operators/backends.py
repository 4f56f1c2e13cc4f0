"""Opaque batch functions: a pluggable backend, the control flow around it, and one that needs no service."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_HALVINGS = 3


class Backend(Protocol):
    """Takes the inputs of a batch and gives an answer for each it could judge, or None if the call failed."""

    def call(self, inputs: list[dict]) -> list[dict] | None: ...


class NullBackend:
    """For dry runs: counts what would be sent and answers nothing."""

    def __init__(self) -> None:
        self.calls = self.rows = 0

    def call(self, inputs: list[dict]) -> list[dict] | None:
        self.calls, self.rows = self.calls + 1, self.rows + len(inputs)
        return []


class Routed:
    """The first of several backends that gives an answer."""

    def __init__(self, *backends: Backend):
        self.backends = backends

    def call(self, inputs: list[dict]) -> list[dict] | None:
        return next((got for b in self.backends if (got := b.call(inputs)) is not None), None)


_MONEY = r"(\d[\d,]*(?:\.\d+)?)"
_PERIOD = {"annum": "year", "year": "year", "yearly": "year", "month": "month", "monthly": "month", "week": "week", "weekly": "week", "day": "day", "diem": "day"}


def parse_price(raw: str | None) -> dict:
    """price_numeric, currency_original, quantity, time_unit and confidence of a price as written.

    "5s 6d" is 5.5 shilling, "£2 10s" 2.5 pound, a range its middle with a confidence of at most 0.7, a
    quarterly price one for three months. A text without a number gives a null price.
    """
    text = (raw or "").lower().strip()
    out = {"price_numeric": None, "currency_original": "uncertain", "quantity": 1.0, "time_unit": None, "confidence": 0.9}
    for word, unit in _PERIOD.items():
        if re.search(rf"\b(?:per |a |/)?{word}\b", text):
            out["time_unit"] = unit
    if "quarterly" in text or "per quarter" in text:
        out["time_unit"], out["quantity"] = "month", 3.0
    value = lambda x: float(x.replace(",", ""))
    if m := re.search(rf"£ ?{_MONEY}(?: (\d+)s\.?)?(?: (\d+)d\.?)?", text):
        out |= {"price_numeric": value(m[1]) + int(m[2] or 0) / 20 + int(m[3] or 0) / 240, "currency_original": "pound"}
    elif m := re.search(r"(\d+) ?s\.?(?: (\d+(?:\.\d+)?) ?d\.?)?(?![a-z])", text):
        out |= {"price_numeric": int(m[1]) + float(m[2] or 0) / 12, "currency_original": "shilling"}
    elif m := re.search(rf"\$ ?{_MONEY}(?: ?[-–—] ?\$? ?{_MONEY})?", text):
        low, high = value(m[1]), value(m[2]) if m[2] else None
        out |= {"price_numeric": low if high is None else (low + high) / 2, "currency_original": "USD"}
        if high is not None:
            out["confidence"] = 0.7
    elif m := re.search(rf"{_MONEY} ?(cents?|cts?\.?|c\.)", text):
        out |= {"price_numeric": value(m[1]), "currency_original": "cent"}
    elif m := re.search(rf"{_MONEY} ?(dollars?|dolls?\.?)", text):
        out |= {"price_numeric": value(m[1]), "currency_original": "USD"}
    elif m := re.search(_MONEY, text):
        out |= {"price_numeric": value(m[1]), "confidence": 0.5}
    return out


class RuleBackend:
    """Reads the price texts by rule; needs no service, and is what tests and offline runs use."""

    def __init__(self, field: str = "price_raw"):
        self.field = field

    def call(self, inputs: list[dict]) -> list[dict] | None:
        return [{"idx": x["idx"]} | parse_price(x.get(self.field)) for x in inputs]


def submit(backend: Backend, inputs: list[dict], is_refusal: Callable[[list[dict]], bool] = lambda _: False, depth: int = 0) -> tuple[list[dict], list[dict]]:
    """(answers, failed): a failed or refused batch is halved up to MOST_HALVINGS times, what is left then has failed.

    Unanswered inputs are sent once more by themselves. failed rows carry the reason and the depth.
    """
    got = backend.call(inputs)
    if got is None or is_refusal(got):
        if depth >= MOST_HALVINGS or len(inputs) == 1:
            why = "no answer" if got is None else "refused"
            return [], [x | {"_failed_reason": why, "_halving_depth": depth} for x in inputs]
        half = len(inputs) // 2
        a, b = (submit(backend, part, is_refusal, depth + 1) for part in (inputs[:half], inputs[half:]))
        return a[0] + b[0], a[1] + b[1]
    known = {x["idx"] for x in inputs}
    answers = {a["idx"]: a for a in got if a.get("idx") in known}  # the last of several counts
    if not any("idx" in a for a in got) and len(got) == len(inputs):
        answers = {x["idx"]: a | {"idx": x["idx"]} for x, a in zip(inputs, got, strict=True)}
    failed = []
    for x in inputs:
        if x["idx"] not in answers:
            again = backend.call([x])
            one = next((a for a in again or [] if a.get("idx", x["idx"]) == x["idx"]), None)
            if one is None:
                failed.append(x | {"_failed_reason": "no answer", "_halving_depth": depth})
            else:
                answers[x["idx"]] = one | {"idx": x["idx"]}
    return [answers[x["idx"]] for x in inputs if x["idx"] in answers], failed


def parse_answer(text: str | None) -> list | None:
    """The JSON array in an answer, with or without a code fence; anything else gives None."""
    body = re.sub(r"^\s*```[a-z]*\s*|\s*```\s*$", "", text or "")
    try:
        got = json.loads(body)
    except ValueError:
        return None
    return got if isinstance(got, list) else None


FAILURE = "_failed_reason string, _halving_depth int"


def run_batches(items: DataFrame, make: Callable[[], Backend], schema: str, batch: str = "batch", is_refusal: Callable[[list[dict]], bool] = lambda _: False) -> DataFrame:
    """Each batch through a backend built once in each task: rows of schema (idx and batch among them) and of FAILURE.

    An answer has a null _failed_reason. An input that stayed without one comes back with the reason, the depth of halving and
    those of its columns that schema names. A batch is never cut where Arrow cuts the rows; a null batch is a batch.
    """
    names = [x.split()[0] for x in f"{schema}, {FAILURE}".split(", ")]

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: list[pd.DataFrame] = []
        for pdf in batches:
            for key, part in pdf.groupby(batch, sort=False, dropna=False):
                if waiting and not (waiting[-1][batch].iloc[0] == key or (pd.isna(key) and pd.isna(waiting[-1][batch].iloc[0]))):
                    yield pd.concat(waiting)
                    waiting = []
                waiting.append(part)
        if waiting:
            yield pd.concat(waiting)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        backend = make()
        for part in whole(batches):
            inputs = part.astype(object).where(part.notna(), None).to_dict("records")
            answers, failed = submit(backend, inputs, is_refusal)
            rows = [a | {batch: inputs[0][batch]} for a in answers] + failed
            yield pd.DataFrame([{c: r.get(c) for c in names} for r in rows], columns=names)

    return items.repartition(batch).sortWithinPartitions(batch, "idx").mapInPandas(run, f"{schema}, {FAILURE}")


def answered(done: DataFrame) -> DataFrame:
    return done.where("_failed_reason IS NULL").drop("_failed_reason", "_halving_depth")


def retry_failed(items: DataFrame, done: DataFrame, make: Callable[[], Backend], schema: str, batch: str = "batch") -> DataFrame:
    """What run_batches() gave, with every failed input sent once more by the same batch; failures of the second run stay failures."""
    lost = done.where("_failed_reason IS NOT NULL").select(F.col(batch).alias("__b"), F.col("idx").alias("__i"))
    again = items.join(lost, F.col(batch).eqNullSafe(F.col("__b")) & (F.col("idx") == F.col("__i")), "left_semi")
    return done.where("_failed_reason IS NULL").unionByName(run_batches(again, make, schema, batch))


def with_status(done: DataFrame, unresolvable: str = "price_numeric IS NULL") -> DataFrame:
    """Adds status: failed (no answer, may be sent again), unresolved (an answer that settles nothing) or normalized; sinks.route() splits by it."""
    return done.selectExpr("*", f"CASE WHEN _failed_reason IS NOT NULL THEN 'failed' WHEN {unresolvable} THEN 'unresolved' ELSE 'normalized' END AS status")
