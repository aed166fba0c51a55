"""Exact linking over inverted lists whose groups may be very large, without emitting the pairs of a group.

A list holds the ids that share a key. At first, each id is paired with the least leader of all its lists alone, so that a
group of near copies collapses with as many pairs as ids. In each further round, each list pairs its least id, the
leader, with its other ids that are not yet in the leader's component; pairs are verified, components updated, and the
leader, now compared with everything it had to be, leaves the list. Lists whose ids are all in one component are done.
Once the lists are so short that few pairs an entry remain, or after ``rounds`` rounds, the pairs across components that
remain are verified too, so no link between components is missed.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import Scratch, components, least_labels

Verify = Callable[[DataFrame], DataFrame]
#: (condition) of two structs of what else an entry holds: whether the pair may be linked by this list.
Fits = Callable[[Column, Column], Column]
#: With so many pairs an entry or fewer, lists are joined with themselves instead of in further rounds.
PAIRS_AN_ENTRY = 4
#: Neighbours that a row of a list is held against; longer lists that do not fall apart by then stay whole.
NEIGHBOURS = 4096


def parts(group: np.ndarray, reach: Callable, allow: Callable, whole: np.ndarray | None = None) -> np.ndarray:
    """The part of each row of sorted groups, by the number of a row in it: rows that may be linked are in one.

    ``reach(x, y)``: whether row y may be linked with a row x before it by what groups are sorted by; if not, none behind y
    may. ``allow(x, y)``: whether what else is known allows it. ``whole``: rows whose groups stay as they are.
    """
    n = len(group)
    root = np.arange(n)
    first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    number = np.repeat(np.arange(len(first)), np.diff(np.append(first, n)))
    stays = np.logical_or.reduceat(whole, first) if whole is not None else np.zeros(len(first), bool)
    u, v = [], []
    x, d = np.flatnonzero(~stays[number]), 0
    while len(x):
        d += 1
        x = x[x < n - d]
        x = x[group[x] == group[x + d]]
        x = x[reach(x, x + d)]
        if d > NEIGHBOURS:
            stays[number[x]] = True
            break
        a = x[root[x] != root[x + d]]
        a = a[allow(a, a + d)]
        u.append(root[a])
        v.append(root[a + d])
        if d & (d - 1) == 0:
            root, u, v = _joined(root, u, v), [], []
            done = np.minimum.reduceat(root, first) == np.maximum.reduceat(root, first)
            x = x[~done[number[x]]]
    root = _joined(root, u, v)
    return np.where(stays[number], first[number], root)


def _joined(root: np.ndarray, u: list[np.ndarray], v: list[np.ndarray]) -> np.ndarray:
    if not sum(map(len, u)):
        return root
    ids, least = least_labels(np.concatenate(u), np.concatenate(v))
    to = np.arange(len(root))
    to[ids] = least
    return to[root]


def _led(lists: DataFrame, comps: DataFrame | None, more: list[str]) -> DataFrame:
    """(key, id, *more, length, comp, lead, lead_comp, lead_more) of the lists with ids of several components."""
    by_key = Window.partitionBy("key")
    order = ["rank"] if "rank" in lists.columns else []
    if comps is None and not more and not order:  # each id is its component: two columns are dealt, not three
        led = lists.withColumns({"lead": F.min("id").over(by_key), "high": F.max("id").over(by_key), "length": F.count("*").over(by_key)}).where("lead <> high")
        return led.select("key", "id", "length", F.col("id").alias("comp"), "lead", F.col("lead").alias("lead_comp"))
    led = _with_components(lists, comps).withColumns({"lead": F.min(F.struct(*order, "id", "comp", *more)).over(by_key), "low": F.min("comp").over(by_key), "high": F.max("comp").over(by_key), "length": F.count("*").over(by_key)})
    held = [F.struct(*(f"lead.{c}" for c in more)).alias("lead_more")] if more else []
    return led.where("low <> high").select("key", "id", *order, *more, "length", "comp", F.col("lead.id").alias("lead"), F.col("lead.comp").alias("lead_comp"), *held)


def _with_components(lists: DataFrame, comps: DataFrame | None) -> DataFrame:
    if comps is None:
        return lists.withColumn("comp", F.col("id"))
    return lists.join(comps, "id", "left").withColumn("comp", F.coalesce("root", "id")).drop("root")


def link(scratch: Scratch, lists: DataFrame, verify: Verify, rounds: int = 4, known: DataFrame | None = None, prepare: Callable[[DataFrame], None] | None = None, fits: Fits | None = None, details: DataFrame | None = None, fits_last: Fits | None = None, met: bool = False, in_lists: Verify | None = None, rank: DataFrame | None = None) -> DataFrame | None:
    """(id, root) of the ids that have links.

    ``lists``: (key, id), and columns for ``fits``. A pair that is linked has to fit in at least one list. ``verify`` gives, of pairs (a, b), those that are linked. ``known``: links found by other means.
    ``prepare`` is called once, with the ids that may be verified. ``details``: (id, columns) that the last join has besides;
    there, ``fits_last`` has to hold as well. ``met``: the lists are (key, id, lead, length) of keys that several ids share,
    those of two ids as one row, which is done with once the pair is verified. ``in_lists`` gives the links across components
    within the lists (key, id, comp, length) that remain, instead of a join of the lists with themselves.
    ``rank`` (id, rank): from the second round on the id of least rank leads a list; what most others are like should have it.
    """
    links = scratch.write(known, "links") if known is not None else None
    comps = components(scratch, links) if links is not None else None
    live = lists
    more = [] if met else [c for c in lists.columns if c not in ("key", "id")]
    entry = ["key", "id", *more]
    pair = None
    if met:
        pair = lists.where("length = 2").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()
        live = lists.where("length > 2").withColumns({"comp": F.col("id"), "lead_comp": F.col("lead")})
    for turn in range(rounds):
        if pair is None or turn:
            old, live = live, scratch.write(_led(live, comps, more), "lists")
            scratch.drop(old)
        elif lists.isEmpty():
            return comps
        if (pair is None or turn) and live.isEmpty():
            return comps
        if in_lists is None and turn and live.agg(F.coalesce(F.sum("length") - F.count("*") <= 2 * PAIRS_AN_ENTRY * F.count("*"), F.lit(True))).first()[0]:
            break
        if prepare and not turn:
            prepare(live.select("id").distinct())
        across = live.where("comp <> lead_comp")
        across = across.where(fits(F.col("lead_more"), F.struct(*more))) if fits and more else across
        pairs = across.select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct() if turn else across.groupBy(F.col("id").alias("b")).agg(F.min("lead").alias("a")).select("a", "b")
        pairs = pairs.unionByName(pair).distinct() if pair is not None and not turn else pairs
        found = scratch.write(verify(pairs), "links")
        if not found.isEmpty():
            links = found if comps is None else found.unionByName(comps.select(F.col("id").alias("a"), F.col("root").alias("b")))
            comps = components(scratch, links)
        scratch.release()
        if turn:
            old, live = live, scratch.write(live.where("id <> lead").select(entry), "lists")
            scratch.drop(old)
        else:
            live = live.select(entry)
            if rank is not None:
                live = live.join(rank, "id")
                entry.append("rank")
    else:
        old, live = live, scratch.write(_led(live, comps, more), "lists")
        scratch.drop(old)
        if live.isEmpty():
            return comps
    if in_lists is not None:
        found = scratch.write(in_lists(live.select("key", "id", "comp", "length")), "links")
        scratch.drop(live)
        if found.isEmpty():
            return comps
        return components(scratch, found if comps is None else found.unionByName(comps.select(F.col("id").alias("a"), F.col("root").alias("b"))))
    left = live.select(*entry, "comp")
    x, y = left.alias("x"), left.alias("y")
    met = (F.col("x.key") == F.col("y.key")) & (F.col("x.id") < F.col("y.id")) & (F.col("x.comp") != F.col("y.comp"))
    if details is not None:
        more = [*more, *(c for c in details.columns if c != "id")]
        both = left.join(details, "id")
        x, y = both.alias("x"), both.alias("y")
    for holds in filter(None, (fits, fits_last)):
        met = met & holds(*(F.struct(*(F.col(f"{side}.{c}").alias(c) for c in more)) for side in "xy"))
    pairs = x.join(y, met).select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()
    found = scratch.write(verify(pairs), "links")
    if found.isEmpty():
        return comps
    return components(scratch, found if comps is None else found.unionByName(comps.select(F.col("id").alias("a"), F.col("root").alias("b"))))
