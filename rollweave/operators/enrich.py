"""Enrichment by an outside model or OCR service, replayed from a table by default."""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..functions.scalars import PRICES

# Features bought for a class in the second pass.
SECOND_PASS = {"student_cover": ("forms", "tables", "layout", "queries", "signatures"), "unknown": ("forms", "tables", "layout", "queries", "signatures"), "student_records_index": ("tables",)}


class Extractor(Protocol):
    """One client per partition; errors are data."""

    def extract(self, row: dict) -> dict: ...


class OcrClient(Protocol):
    """An OCR service. Responses are its JSON documents; prices are taken by feature, so a client only answers."""

    def detect(self, page: bytes) -> str: ...

    def analyze(self, page: bytes, features: tuple[str, ...], queries: list[dict] | None) -> str: ...


def analyze(client: OcrClient, page: bytes, features: tuple[str, ...], queries: list[dict] | None = None) -> tuple[str, float]:
    """One round trip for any features, with retries, and its price: the sum of the features'. Questions are a feature of their own, so they need some."""
    unknown = set(features) - set(PRICES)
    if unknown or not features:
        raise ValueError(f"unknown features: {sorted(unknown)}")
    if "queries" in features and not queries:
        raise ValueError("the queries feature needs at least one query")
    said = with_retry(lambda: client.detect(page) if features == ("detect",) else client.analyze(page, features, queries))
    return said, round(sum(PRICES[f] for f in features), 6)


def ocr(rows: DataFrame, make: Callable[[], OcrClient], features: str, content: str = "content", queries: list[dict] | None = None) -> DataFrame:
    """The rows with ``response`` and ``usd`` of the features in an array column (none: null and 0), and ``error``. For both passes of the cascade: features come from
    extract.second_pass. One client per partition; errors are data."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make()
        for batch in batches:
            out = []
            for page, wanted in zip(batch[content], batch[features], strict=True):
                try:
                    wanted = tuple(wanted) if wanted is not None else ()
                    if "queries" in wanted and not queries:
                        wanted = tuple(f for f in wanted if f != "queries")
                    out.append((*(analyze(client, bytes(page), wanted, queries) if wanted else (None, 0.0)), None))
                except Exception as e:  # noqa: BLE001  the error becomes data
                    out.append((None, 0.0, str(e)[:200]))
            yield pd.concat([batch.reset_index(drop=True), pd.DataFrame(out, columns=["response", "usd", "error"])], axis=1)

    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInPandas(run, f"{own}, response string, usd double, error string")


class Retryable(Exception):
    """A failure that may pass."""


def with_retry(call: Callable, attempts: int = 4, base: float = 1.0, sleep=time.sleep):
    """Doubling waits with jitter."""
    for k in range(attempts):
        try:
            return call()
        except Retryable:
            if k + 1 == attempts:
                raise
            sleep(base * 2**k * (0.5 + random.random() / 2))


def enrich(rows: DataFrame, make: Callable[[], Extractor], fields: str) -> DataFrame:
    """The rows with the extractor's fields and ``error`` (200 characters at most, null if none)."""
    names = [f.strip().split()[0] for f in fields.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make()
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                try:
                    got = with_retry(lambda row=row: client.extract(row))
                    out.append([got.get(n) for n in names] + [None])
                except Exception as e:  # noqa: BLE001  the error becomes data
                    out.append([None] * len(names) + [str(e)[:200]])
            yield pd.concat([batch.reset_index(drop=True), pd.DataFrame(out, columns=[*names, "error"], dtype=object)], axis=1)

    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInPandas(run, f"{own}, {fields}, error string")


def replay(rows: DataFrame, recorded: DataFrame, keys: list[str]) -> DataFrame:
    """Recorded answers by key; what isn't recorded gets an error, as a live call would."""
    found = rows.join(recorded.withColumn("_hit", F.lit(True)), keys, "left")
    return found.withColumn("error", F.when(F.col("_hit").isNull(), "missing")).drop("_hit")


def quarantine(enriched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows without and with an error: failed pages don't vanish."""
    return enriched.where("error is null"), enriched.where("error is not null")
