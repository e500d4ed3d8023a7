"""Rate limiting and circuit breaking over a log of requests."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from lodegate.functions.text import casefold, strip
from lodegate.operators.running import running
from lodegate.scale import lookup_join


def token_bucket(
    requests: DataFrame,
    host: str,
    at_micros: str,
    order: str,
    *,
    rate_per_second: float,
    burst: int,
    carried: DataFrame | None = None,
) -> DataFrame:
    """Add ``granted_micros`` and ``full_at_micros``: when each request gets its token, first
    come first served, and when its bucket would be full again.

    A host starts with ``burst`` tokens and regains ``rate_per_second``. With
    spacing T between tokens the n-th request of a host is granted at
    max(arrival, (n - burst) * T + max over earlier k of (arrival_k - (k - 1) * T)),
    so a running count and a running maximum replace the simulation. ``carried``
    holds the last full_at_micros of hosts from an earlier batch.
    """
    if rate_per_second <= 0 or burst < 1:
        raise ValueError("rate_per_second and burst must be positive")
    spacing = F.lit(1_000_000.0 / rate_per_second)
    keyed = requests.withColumn("_host", host_key(F.col(host)))
    numbered = running(keyed, ["_host"], [at_micros, order], sums={"_n": F.lit(1).cast("long")})
    shifted = running(
        numbered, ["_host"], [at_micros, order], maxima={"_m": F.col(at_micros) - (F.col("_n") - 1) * spacing}
    )
    if carried is not None:
        earlier = carried.select(host_key(F.col(host)).alias("_host"), F.col("full_at_micros").alias("_full"))
        joined = lookup_join(shifted, earlier, ["_host"], "left", spread=F.col(order))
        shifted = joined.withColumn("_m", F.greatest("_m", "_full")).drop("_full")
    granted = F.greatest(F.col(at_micros).cast("double"), (F.col("_n") - burst) * spacing + F.col("_m"))
    return shifted.withColumns(
        {"granted_micros": granted, "full_at_micros": F.col("_n") * spacing + F.col("_m")}
    ).drop("_host", "_n", "_m")


def host_key(host: Column) -> Column:
    return casefold(strip(host))


class Breaker:
    """State of one provider's circuit: CLOSED, OPEN after enough failures, then one trial call."""

    def __init__(self, threshold: int, cooldown_micros: int) -> None:
        self.threshold, self.cooldown = threshold, cooldown_micros
        self.reset()

    def reset(self) -> None:
        self.failures, self.opened_at = 0, None

    def call(self, at: int, failed: bool) -> tuple[bool, str, int]:
        """(allowed, state afterwards, failures afterwards) for a call at ``at``."""
        trial = self.opened_at is not None
        if trial and at - self.opened_at < self.cooldown:
            return False, "OPEN", self.failures
        if not failed:
            self.reset()
            return True, "CLOSED", 0
        self.failures += not trial
        if trial or self.failures >= self.threshold:
            self.opened_at = at
            return True, "OPEN", self.failures
        return True, "CLOSED", self.failures


def circuit_breaker(
    calls: DataFrame,
    provider: str,
    at_micros: str,
    order: str,
    failed: str,
    *,
    threshold: int = 5,
    cooldown_seconds: float = 60.0,
    carried: DataFrame | None = None,
) -> DataFrame:
    """Add allowed, state, failures and opened_at to every call of a log.

    A success at least one cooldown after the provider's last failing call
    closes the circuit whatever happened before, so the log splits there into
    stretches that are replayed independently. A replay reads its stretch as a
    sorted stream and keeps only one state in memory. ``carried`` holds the
    failures and opened_at of providers after an earlier batch.
    """
    if threshold < 1 or cooldown_seconds < 0:
        raise ValueError("threshold must be positive and cooldown not negative")
    cooldown = int(cooldown_seconds * 1_000_000)
    keys, along = [provider], [at_micros, order]
    columns = calls.columns
    if carried is None:
        calls = calls.withColumns({"_failures": F.lit(0), "_opened": F.lit(None).cast("long")})
    else:
        before = carried.select(provider, F.col("failures").alias("_failures"), F.col("opened_at").alias("_opened"))
        calls = lookup_join(calls, before, keys, "left", spread=F.col(order)).na.fill(0, ["_failures"])
    failures = running(calls, keys, along, maxima={"_failed_at": F.greatest(F.when(F.col(failed), F.col(at_micros)), "_opened")})
    quiet = ~F.col(failed) & (
        F.col("_failed_at").isNull() | (F.col(at_micros) - F.col("_failed_at") >= cooldown)
    )
    split = running(
        failures.withColumn("_quiet", quiet).drop("_failed_at"), keys, along, sums={"_stretch": F.col("_quiet").cast("long")}
    )
    schema = T.StructType(
        [split.schema[name] for name in columns]
        + [
            T.StructField("allowed", T.BooleanType()),
            T.StructField("state", T.StringType()),
            T.StructField("failures", T.IntegerType()),
            T.StructField("opened_at", T.LongType()),
        ]
    )

    def replay(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        breaker, current = Breaker(threshold, cooldown), None
        for batch in batches:
            results = []
            read = (provider, "_stretch", at_micros, failed, "_failures", "_opened")
            for name, stretch, at, bad, failures, opened in zip(*(batch[column] for column in read)):
                if (name, stretch) != current:
                    breaker.reset()
                    if stretch == 0:
                        breaker.failures, breaker.opened_at = int(failures), None if pd.isna(opened) else int(opened)
                    current = (name, stretch)
                results.append((*breaker.call(int(at), bool(bad)), breaker.opened_at))
            told = pd.DataFrame(results, columns=["allowed", "state", "failures", "opened_at"], index=batch.index)
            told["opened_at"] = told["opened_at"].astype("Int64")
            yield pd.concat([batch[columns], told], axis=1)

    sorted_calls = split.repartition(provider, "_stretch").sortWithinPartitions(provider, "_stretch", *along)
    return sorted_calls.mapInPandas(replay, schema)
