"""Submission of packets in sets: what fits a set, and what a queue's refusals teach about its size."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .steps import running

# The documented limits of a set, and how long a queue that takes nothing is left alone.
MOST_BYTES, MOST_REQUESTS, PAUSE_SECONDS = 200_000_000, 50_000, 30
OVER = ("completed", "failed", "expired", "cancelled")


def next_set(pending: DataFrame, budget: float, ceiling: int = MOST_REQUESTS, most_bytes: int = MOST_BYTES, order: tuple[str, ...] = ("place",)) -> DataFrame:
    """The pending packets that go next, in order, as long as their costs, bytes and number stay within the limits: sums
    over all before each one, so no task sees all packets. pending: request_id, amount, bytes and the order. One packet
    over the limit of bytes ends the job."""
    most = pending.where(F.when(F.col("bytes") <= most_bytes, True).otherwise(F.raise_error(F.concat(F.lit("request exceeds a set's bytes: "), "request_id"))))
    micro = F.ceil(F.col("amount").cast("decimal(18,6)") * 1_000_000)
    sums = running(most.withColumn("_micro", micro.cast("long")), list(order), _n=F.lit(1), _bytes=F.col("bytes"), _cost=F.col("_micro"))
    fits = (F.col("_n") < ceiling) & (F.col("_bytes") + F.col("bytes") <= most_bytes) & (F.col("_cost") + F.col("_micro") <= int(round(budget * 1_000_000)))
    return sums.where(fits).select(*pending.columns)


@dataclass
class Capacity:
    """What refusals have taught: the sets heard of, the most requests a set may have, the sets that were under way when
    the last one was refused, and when to try again."""

    seen: set[str] = field(default_factory=set)
    ceiling: int = MOST_REQUESTS
    active_at_refusal: set[str] = field(default_factory=set)
    next_attempt: float = 0.0
    limit_tokens: int | None = None
    most: int = MOST_REQUESTS

    def heard(self, active: set[str], refusals: list[tuple[str, int, int | None, bool]], now: float) -> Capacity:
        """After refusals (ticket, requests, named limit, whether only the rate was refused) with these sets under way: each
        counts once; one of the queue halves the set, down to one; one of a single request, or of the rate, pauses. When a
        set that was under way is over, the queue has room again."""
        if self.active_at_refusal - active:
            self.ceiling, self.active_at_refusal = self.most, set()
        for ticket, count, limit, rate in refusals:
            if ticket in self.seen:
                continue
            self.seen.add(ticket)
            if not rate:
                self.ceiling, self.active_at_refusal, self.limit_tokens = max(1, min(self.ceiling, count // 2)), set(active), limit
            if count == 1 or rate:
                self.next_attempt = now + PAUSE_SECONDS
        return self


def still_pending(packets: DataFrame, sets: DataFrame, responses: DataFrame) -> DataFrame:
    """Packets that no set holds but those refused, and that have no response. sets: request_id, refused."""
    held = sets.where("not refused").select("request_id")
    return packets.join(held, "request_id", "left_anti").join(responses.select("request_id"), "request_id", "left_anti")


def ceilings(ticks: DataFrame, most: int = MOST_REQUESTS) -> DataFrame:
    """(queue, tick, ceiling): the same rule as a fold over each queue's ticks, for a history of many queues.

    ticks: queue, tick, active (ids of sets under way), refusals (ticket, requests, rate). A queue's ticks are the polls of
    one run and meet in one array.
    """
    item = F.struct("tick", "active", "refusals")
    one = ticks.groupBy("queue").agg(F.array_sort(F.collect_list(item)).alias("ticks"))
    none = F.array().cast("array<string>")
    start = F.struct(F.lit(most).alias("ceiling"), none.alias("at"), none.alias("seen"), F.array().cast("array<struct<tick:bigint,ceiling:int>>").alias("out"))

    def refused(active: Column):
        def step(a: Column, r: Column) -> Column:
            fresh = ~F.array_contains(a["seen"], r["ticket"])
            lower = fresh & ~r["rate"]
            half = F.greatest(F.lit(1), F.least(a["ceiling"], F.floor(r["requests"] / 2).cast("int")))
            return F.struct(F.when(lower, half).otherwise(a["ceiling"]).alias("ceiling"), F.when(lower, active).otherwise(a["at"]).alias("at"), F.when(fresh, F.array_append(a["seen"], r["ticket"])).otherwise(a["seen"]).alias("seen"))

        return step

    def step(a: Column, t: Column) -> Column:
        freed = F.size(F.array_except(a["at"], t["active"])) > 0
        before = F.struct(F.when(freed, most).otherwise(a["ceiling"]).cast("int").alias("ceiling"), F.when(freed, none).otherwise(a["at"]).alias("at"), a["seen"].alias("seen"))
        after = F.transform(F.array(F.aggregate(t["refusals"], before, refused(t["active"]))), lambda s: F.struct(s["ceiling"].alias("ceiling"), s["at"].alias("at"), s["seen"].alias("seen"), F.array_append(a["out"], F.struct(t["tick"].cast("bigint").alias("tick"), s["ceiling"].alias("ceiling"))).alias("out")))
        return F.get(after, F.lit(0))

    return one.select("queue", F.explode(F.aggregate("ticks", start, step)["out"]).alias("x")).select("queue", "x.tick", "x.ceiling")
