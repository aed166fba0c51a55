"""Chapters, previews and subsets of a frame list: what a cut shows, and which frames stand for the whole."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import nearest

#: (chapter, weight of its share, end of the run that is shown), in order.
CHAPTERS = (("partial phases", 1.0, "end"), ("the filter coming off", 1.0, "start"), ("second contact", 1.5, "start"), ("totality", 1.5, "middle"))


@dataclass(frozen=True)
class Preview:
    seconds: float = 9.0
    fps: int = 10
    #: A chapter that would be shorter is left out.
    least_seconds: float = 1.0

    @property
    def budget(self) -> int:
        return round(self.seconds * self.fps)

    @property
    def floor(self) -> int:
        return round(self.least_seconds * self.fps)


def chapter_predicates(state: str = "state", resolve: str = "resolve", bead: str = "bead") -> dict[str, Column]:
    """Whether a frame belongs to each chapter."""
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    filtered, unfiltered = (F.coalesce(F.col(state) == s, F.lit(False)) for s in ("filtered", "unfiltered"))
    return dict(zip((c[0] for c in CHAPTERS), (filtered & ~yes(resolve), yes(resolve), yes(bead), unfiltered & ~yes(bead) & ~yes(resolve)), strict=True))


def pick_segments(frames: DataFrame, keys: Sequence[str], seq: str, spec: Preview = Preview()) -> DataFrame:
    """(keys, chapter, start, count): a preview's spans. The budget is split by weight over the chapters that a key has.

    Of partial phases the run that ends last before totality is shown, else the longest; of others the longest; the first
    on ties. A key without any span shows its beginning.
    """
    w, whole = Window.partitionBy(*keys).orderBy(seq), Window.partitionBy(*keys)
    yes = {f"__c{k}": p for k, p in enumerate(chapter_predicates().values())}
    marked = frames.select(*keys, seq, *(p.alias(c) for c, p in yes.items()), (F.col("state") == "unfiltered").alias("__total"))
    # frames of a run have the same place in the key less their place in the chapter; a frame without a chapter keeps its key
    at, inside = F.row_number().over(w), w.rowsBetween(Window.unboundedPreceding, 0)
    each = F.array_compact(F.array(*(F.when(F.col(c), F.struct(F.lit(k).alias("k"), (at - F.sum(F.col(c).cast("int")).over(inside)).alias("run"))) for k, c in enumerate(yes))))
    placed = marked.select(*keys, seq, each.alias("__each"), F.count("*").over(whole).alias("__n"), F.min(F.when(F.col("__total"), F.col(seq))).over(whole).alias("__t0"))
    of_key = (F.max("__n").alias("__n"), F.max("__t0").alias("__t0"))
    runs = placed.select(*keys, seq, "__n", "__t0", F.explode_outer("__each").alias("c")).groupBy(*keys, F.col("c.k").alias("__k"), F.col("c.run").alias("__run")).agg(F.min(seq).alias("start"), F.count("*").alias("count"), *of_key)
    end = F.col("start") + F.col("count")
    early = F.coalesce((F.col("__k") == 0) & (F.col("__t0").isNull() | (end <= F.col("__t0"))), F.lit(False))
    rank = F.struct(early.alias("early"), F.when(early, end).otherwise(F.col("count")).alias("size"), (-F.col("start")).alias("first"))
    best = runs.groupBy(*keys, "__k").agg(F.max_by(F.struct("start", "count"), rank).alias("r"), *of_key)
    chapter, weight, where = (F.array(*(F.lit(c[i]) for c in CHAPTERS))[F.col("__k")] for i in range(3))
    share = F.bround(spec.budget * F.col("weight") / F.sum("weight").over(whole)).cast("long")
    named = best.withColumns({"chapter": chapter, "weight": weight, "where": where})
    sized = named.withColumn("want", share).withColumn("n", F.least("want", "r.count"))
    fits = sized.withColumn("__fits", F.coalesce((F.col("want") >= spec.floor) & (F.col("n") >= spec.floor), F.lit(False)))
    left = F.col("r.count") - F.col("n")
    shift = F.when(F.col("where") == "start", 0).when(F.col("where") == "end", left).otherwise(F.floor(left / 2))
    span = F.struct("chapter", (F.col("r.start") + shift).alias("start"), F.col("n").alias("count"))
    beginning = F.struct(F.lit("the whole sequence").alias("chapter"), F.lit(0).cast("long").alias("start"), F.least(F.lit(spec.budget).cast("long"), "__n").alias("count"))
    # a key without a span gives one row: that of its first group
    first = F.row_number().over(whole.orderBy("__k")) == 1
    told = fits.withColumns({"__any": F.max("__fits").over(whole), "__first": first})
    out = told.select(*keys, F.when(F.col("__fits"), span).when(~F.col("__any") & F.col("__first"), beginning).alias("s"))
    return out.where("s IS NOT NULL").select(*keys, "s.*")


def dense_points(segs: DataFrame, samples: DataFrame, key: str, i: str, t: str, seconds: float, fps: float, rate: float, stack: int) -> DataFrame:
    """(key, j, i, t): a row per raw frame of each segment (start, count), repeated to fill ``seconds`` at ``fps``.

    A segment stops ``stack`` frames short of its end. Times follow the nearest sample at ``rate`` raw frames a second.
    Segments with fewer than two frames left give nothing.
    """
    n = F.col("count") - stack
    want = F.greatest(n, F.lit(round(seconds * fps)))
    rows = segs.where(n >= 2).select(key, "start", n.alias("n"), want.alias("want")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("want") - 1)))
    placed = rows.select(key, F.col("j").cast("long").alias("j"), (F.col("start") + F.least(F.col("n") - 1, F.floor(F.col("j") * F.col("n") / F.col("want")))).cast("long").alias(i))
    near = nearest(placed, samples.select(key, i, t), key, i, t)
    return near.select(key, "j", i, (F.col(t) + (F.col(i) - F.col("near_i")) / rate).alias(t))


def sample_frames(frames: DataFrame, keys: Sequence[str], seq: str, clip: Sequence[str], file: str, index: str, gain: str, flags: Sequence[str], gap: int = 40, jump: float = 1.35, dissolve: int = 3) -> DataFrame:
    """(keys, seq) of frames that show every distinct thing: first and middle of each clip, the surroundings of cuts, first, middle and last of each flag."""
    w, whole = Window.partitionBy(*keys).orderBy(seq), Window.partitionBy(*keys)
    inside = w.rowsBetween(Window.unboundedPreceding, 0)
    own = F.when(F.coalesce(F.col(gain), F.lit(0.0)) == 0, 1.0).otherwise(F.col(gain))
    rows = frames.select(*keys, seq, *(F.col(c).alias(f"__clip{k}") for k, c in enumerate(clip)), F.col(file).alias("__file"), F.col(index).alias("__index"), own.alias("__own"), *(F.coalesce(F.col(c), F.lit(False)).alias(f"__flag{k}") for k, c in enumerate(flags)))

    def some(at: Column, n: Column) -> Column:
        return (at == 0) | (at == F.floor(n / 2))

    of_clip = Window.partitionBy(*keys, *(f"__clip{k}" for k in range(len(clip))))
    shown = rows.withColumn("__show", some(F.row_number().over(of_clip.orderBy(seq)) - 1, F.count("*").over(of_clip))).drop(*(f"__clip{k}" for k in range(len(clip))))
    before = F.coalesce(F.lag("__own").over(w), F.lit(1.0))
    cut = (F.col("__file") != F.lag("__file").over(w)) | (F.col("__index") - F.lag("__index").over(w) > gap) | (F.greatest(F.col("__own") / before, before / F.col("__own")) > jump)
    cut = F.lag(seq).over(w).isNotNull() & cut
    marked = shown.withColumn("__cut", F.coalesce(cut, F.lit(False)))
    show = F.col("__show") | (F.max(F.col("__cut").cast("int")).over(w.rowsBetween(-(dissolve + 1), 1)) == 1)
    for k in range(len(flags)):
        flag = F.col(f"__flag{k}")
        at, n = F.sum(flag.cast("int")).over(inside) - 1, F.sum(flag.cast("int")).over(whole)
        show = show | (flag & (some(at, n) | (at == n - 1)))
    return marked.withColumn("__show", show).where("__show").select(*keys, seq).distinct()


def drop_short_transitions(segs: DataFrame, least: int = 3, kind: str = "kind", count: str = "count") -> DataFrame:
    """Segments without the transitions that have too few samples for a level."""
    return segs.where((F.col(kind) != "transition") | (F.col(count) >= least))


def from_start(frames: DataFrame, seq: str, start: int, limit: int | None = None) -> DataFrame:
    """Frames from ``start`` on, the first ``limit`` of them."""
    some = frames.where(F.col(seq) >= start)
    return some if limit is None else some.orderBy(seq).limit(limit)


def first_features(features: Column, most: int) -> Column:
    """The first ``most`` features in their order of priority."""
    return F.slice(features, 1, most)
