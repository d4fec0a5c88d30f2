"""Iterative link ranking.

Two weightings carry the name PageRank here, so neither is a default:

``raw``         a page passes its whole rank along every link
``out_degree``  a page's rank is shared equally among its links

Links are laid out once by source and joined with the ranks in place, so each
iteration moves one partial sum per page and task, never the links.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemill.session import new_folder, shuffle_partitions
from tidemill.sources.buckets import bucketed, write_bucketed
from tidemill.sources.snapshots import drop_frozen, freeze, latest_step, publish, read_step

DAMPING = 0.85
ITERATIONS = 10
CUT_EVERY = 5
HEAVY_ROWS = 1_000_000  # a source with fewer links is never spread
#: Links in a partition, whatever the caller's number of them: a task that counts, sorts and
#: joins its links at once holds some 500 bytes of each, up to 800 if they are not cached.
PARTITION_ROWS = 1_000_000
_PROFILE_BUCKETS = 4096
#: Exact ranks are decimals of this many digits behind the point and sixteen before it.
EXACT_DIGITS = 12
EXACT_RANK = f"decimal(28,{EXACT_DIGITS})"
_SHUFFLE = "spark.sql.shuffle.partitions"


def init_ranks(edges: DataFrame) -> DataFrame:
    """Every distinct source at rank 1. Pages that are only linked to have none yet."""
    return edges.select("source").distinct().withColumn("rank", F.lit(1.0))


def out_degree(edges: DataFrame) -> DataFrame:
    return edges.groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@dataclass
class Links:
    """Distinct links with the share of the source's rank that each carries.

    ``cold`` is hash-partitioned by source and sorted by it. Links of a heavy
    source, or of none, would all land in one of its partitions, so ``spread``
    holds those, partitioned by both ends. ``heavy`` names the heavy sources: fewer
    than there are partitions. ``tables`` are the folders some of this is read from.
    """

    cold: DataFrame
    partitions: int
    spread: DataFrame | None = None
    heavy: DataFrame | None = None
    tables: list[str] = field(default_factory=list)

    def parts(self) -> list[DataFrame]:
        return [self.cold] if self.spread is None else [self.cold, self.spread]

    def drop(self) -> None:
        """Deletes what the layout was read from; nothing may read it any more."""
        for path in self.tables:
            drop_frozen(self.cold.sparkSession, path)


LINK = "source string, target string, share double"
EXACT_LINK = "source string, target string, n long, degree long"
_LAID_OUT = "partitions int, heavy boolean"


def save_layout(links: Links, folder: str) -> Links:
    """Keeps a layout under ``folder`` and returns it as read from there.

    The cold links go to buckets by source, so that whoever opens them again joins them
    in place. What is announced last is all there; without it nothing is.
    """
    spark = links.cold.sparkSession
    write_bucketed(links.cold, f"{folder}/cold", links.partitions, "source")
    if links.spread is not None:
        links.spread.write.mode("overwrite").parquet(f"{folder}/spread")
        links.heavy.write.mode("overwrite").parquet(f"{folder}/heavy")
    said = [(links.partitions, links.spread is not None)]
    spark.createDataFrame(said, _LAID_OUT).coalesce(1).write.mode("overwrite").parquet(f"{folder}/laid-out")
    links.drop()
    return open_layout(spark, folder, links.cold.schema)


def open_layout(spark: SparkSession, folder: str, schema) -> Links | None:
    """The layout under ``folder``, if a whole one is there."""
    try:
        said = spark.read.schema(_LAID_OUT).parquet(f"{folder}/laid-out").first()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    if said is None:
        return None
    cold = bucketed(spark, f"{folder}/cold", schema, said["partitions"], "source")
    cold = cold.sortWithinPartitions("source")
    if not said["heavy"]:
        return Links(cold, said["partitions"])
    spread = spark.read.schema(schema).parquet(f"{folder}/spread")
    heavy = spark.read.schema("source string").parquet(f"{folder}/heavy")
    return Links(cold, said["partitions"], spread, heavy)


@dataclass
class Profile:
    """What one pass over the links tells: how many, where, and which graph it is."""

    buckets: dict[int, int]
    fingerprint: str

    @property
    def total(self) -> int:
        return sum(self.buckets.values())


def lay_out(
    edges: DataFrame,
    *,
    weight: str,
    num_partitions: int | None = None,
    heavy_rows: int = HEAVY_ROWS,
    profile: Profile | None = None,
    exact: bool = False,
) -> Links:
    """Adds up equal links and brings each source's links together.

    ``num_partitions`` is how many are made of few links. Where one would hold more than
    ``PARTITION_ROWS``, all are cut into as many equal parts as it takes.

    Runs a counting job, and where sources are heavy writes their links; call it once for
    any number of steps.
    """
    if weight not in ("raw", "out_degree"):
        raise ValueError(f"weight must be 'raw' or 'out_degree', not {weight!r}")
    spark = edges.sparkSession
    links = edges.select("source", "target")
    profile = profile or profile_links(links)
    partitions = _partitions_for(links, profile, num_partitions)
    heavy, tables = _heavy_sources(links, profile, partitions, heavy_rows)
    near = links
    if heavy is not None:
        # bounded: fewer names than partitions
        named = F.broadcast(heavy)
        near = links.where(F.col("source").isNotNull()).join(named, "source", "left_anti")
    cold = _count_links(near.repartition(partitions, "source"))
    if weight == "raw":
        cold = cold.withColumn("degree", F.lit(1).cast("long")).sortWithinPartitions("source")
    else:
        cold = cold.withColumn("degree", F.sum("n").over(Window.partitionBy("source")))
    cold = _shares(cold, exact)
    if heavy is None:
        return Links(cold, partitions)

    apart = links.where(F.col("source").isNull()).unionAll(
        links.join(named, "source", "left_semi").select("source", "target")
    )
    tables.append(new_folder(spark, "spread"))
    # counted once and sized like the rest, however few partitions the session uses
    counts = _count_links(apart.repartition(partitions, "source", "target"))
    spread = freeze(counts, "spread", tables[-1])
    if weight == "raw":
        spread = spread.withColumn("degree", F.lit(1).cast("long"))
    else:
        # one row per heavy source
        degrees = spread.where(F.col("source").isNotNull()).groupBy("source").agg(
            F.sum("n").alias("degree")
        )
        spread = spread.join(F.broadcast(degrees), "source", "left")
    return Links(cold, partitions, _shares(spread, exact), heavy, tables)


def _shares(counts: DataFrame, exact: bool) -> DataFrame:
    """Exact sums need the two numbers that a share is the quotient of."""
    if exact:
        return counts.select("source", "target", "n", "degree")
    share = F.col("n").cast("double") / F.col("degree")
    return counts.select("source", "target", share.alias("share"))


def _count_links(links: DataFrame) -> DataFrame:
    return links.groupBy("source", "target").agg(F.count(F.lit(1)).alias("n"))


def _bucket() -> Column:
    return F.pmod(F.xxhash64("source"), F.lit(_PROFILE_BUCKETS))


def profile_links(links: DataFrame) -> Profile:
    """Links by bucket of their source, a fixed number of buckets, and a fingerprint.

    The fingerprint is made of the number of links and of two sums over their
    hashes, so it does not depend on their order.
    """
    link = F.xxhash64("source", "target")
    sizes = links.groupBy(_bucket().alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(link.bitwiseAND(F.lit(0xFFFFFF))).alias("low"),
        F.bit_xor(link).alias("mixed"),
    )
    rows = sizes.collect()
    mixed = 0
    for row in rows:
        mixed ^= row["mixed"] & 0xFFFFFFFFFFFFFFFF
    total = sum(row["n"] for row in rows)
    fingerprint = f"{total:x}-{sum(row['low'] for row in rows):x}-{mixed:x}"
    return Profile({row["bucket"]: row["n"] for row in rows}, fingerprint)


def _partitions_for(links: DataFrame, profile: Profile, asked: int | None = None) -> int:
    """Enough for the links and the cores. If the session shuffles into about
    that many, exactly as many, so that ranks come out where they are needed.

    Of what the caller asked for, a multiple that is enough for the links."""
    spark = links.sparkSession
    least = -(-profile.total // PARTITION_ROWS)
    if asked:
        return asked * max(1, -(-least // asked))
    wanted = max(spark.sparkContext.defaultParallelism, least)
    usual = shuffle_partitions(spark)
    return usual if wanted <= usual <= 4 * wanted else wanted


def _heavy_sources(
    links: DataFrame, profile: Profile, partitions: int, heavy_rows: int
) -> tuple[DataFrame | None, list[str]]:
    """A table of the named sources with more links than an average partition holds,
    or none if no source has, and where it is.

    Single sources are looked at only in buckets big enough to hold one.
    """
    limit = max(heavy_rows, profile.total // partitions)
    full = [bucket for bucket, count in profile.buckets.items() if count > limit]
    if not full:
        return None, []
    counted = links.where(_bucket().isin(full)).groupBy("source").count()
    path = new_folder(links.sparkSession, "heavy")
    found = freeze(counted.where(F.col("count") > limit).select("source"), "heavy", path)
    if found.isEmpty():
        drop_frozen(links.sparkSession, path)
        return None, []
    return found.where(F.col("source").isNotNull()), [path]


@contextmanager
def shuffling_into(spark: SparkSession, partitions: int):
    """The session's number of shuffle partitions, changed for what runs inside.

    Sums by target then come out where the links of these sources are, and one
    exchange serves both.
    """
    usual = spark.conf.get(_SHUFFLE)
    spark.conf.set(_SHUFFLE, str(partitions))
    try:
        yield
    finally:
        spark.conf.set(_SHUFFLE, usual)


def _next_ranks(
    links: Links, ranks: DataFrame | None, damping: float, missing: str, exact: bool = False
) -> DataFrame:
    """One iteration. ``ranks=None`` stands for the start, rank 1 everywhere."""
    if ranks is None:
        one = F.lit(1).cast(EXACT_RANK) if exact else F.lit(1.0)
        rank = F.when(F.col("source").isNotNull(), one)
        shared = [part.withColumn("rank", rank) for part in links.parts()]
    else:
        shared = [links.cold.join(ranks, "source", "left")]
        if links.spread is not None:
            # ranks hold a page once, so this is one row per heavy source
            few = F.broadcast(ranks.join(F.broadcast(links.heavy), "source", "left_semi"))
            shared.append(links.spread.join(few, "source", "left"))
    columns: list[Column | str] = ["target", _rank_column(damping, missing, exact)]
    columns += ["n", "degree"] if exact else ["share"]
    passed = shared[0].select(*columns)
    for part in shared[1:]:
        passed = passed.unionAll(part.select(*columns))
    if exact:
        # decimals add up to the same whatever the order, and no step of this loses a digit
        # but the two casts, each of which rounds one number by itself
        wide = f"decimal(38,{EXACT_DIGITS})"
        times = F.col("rank") * F.col("n").cast("decimal(9,0)")
        divided = (times / F.col("degree").cast("decimal(10,0)")).cast(wide)
        # most links are there once and raw ones are shares of nothing: the rank as it is
        whole = (F.col("n") == 1) & (F.col("degree") == 1)
        each = F.when(whole, F.col("rank").cast(wide)).otherwise(divided)
        damped = F.sum(each).cast(f"decimal(34,{EXACT_DIGITS})") * _two_digits(damping)
        rank = (damped + _two_digits(_floor(damping))).cast(EXACT_RANK)
        return passed.groupBy("target").agg(rank.alias("rank")).withColumnRenamed("target", "source")
    return (
        passed.groupBy("target")
        .agg(F.sum(F.col("rank") * F.col("share")).alias("contrib"))
        .select(
            F.col("target").alias("source"),
            (F.col("contrib") * damping + _floor(damping)).alias("rank"),
        )
    )


def _two_digits(number: float) -> Column:
    if round(number, 2) != number:
        raise ValueError("exact sums need a damping of two digits")
    return F.lit(f"{number:.2f}").cast("decimal(2,2)")


def _floor(damping: float) -> float:
    """The rank of a page nobody links to."""
    return round(1 - damping, 12)


def _rank_column(damping: float, missing: str, exact: bool) -> Column:
    if missing == "null":
        return F.col("rank")
    if missing == "teleport":
        floor = F.lit(f"{_floor(damping):.2f}").cast(EXACT_RANK) if exact else F.lit(_floor(damping))
        unranked = F.when(F.col("source").isNotNull(), floor)
        return F.coalesce(F.col("rank"), unranked).alias("rank")
    raise ValueError(f"missing must be 'null' or 'teleport', not {missing!r}")


def rank_edges(
    edges: DataFrame, ranks: DataFrame, *, weight: str, damping: float = DAMPING, missing: str = "null"
) -> DataFrame:
    """``rank_step`` over links as they are, for a single step: nothing is laid out.

    Links go to the ranks by source once and partial sums go to the targets. Spark splits
    a partition that a hot source fills while the join runs.
    """
    if weight == "out_degree":
        # of sources alone: adding up the degrees costs a row per source and task
        degrees = edges.groupBy("source").agg(F.count(F.lit(1)).alias("degree"))
        links = edges.join(degrees, "source", "left")
        links = links.select("source", "target", (F.lit(1.0) / F.col("degree")).alias("share"))
    elif weight == "raw":
        links = edges.select("source", "target", F.lit(1.0).alias("share"))
    else:
        raise ValueError(f"weight must be 'raw' or 'out_degree', not {weight!r}")
    return _next_ranks(Links(links, shuffle_partitions(edges.sparkSession)), ranks, damping, missing)


def rank_step(
    links: Links, ranks: DataFrame, *, damping: float = DAMPING, missing: str = "null"
) -> DataFrame:
    """New ranks of all targets from the ranks of the sources, each of which is there once.

    A source without a rank passes nothing on; a target that gets nothing at all
    has a null rank, unless ``missing="teleport"`` gives unranked sources the
    rank of a page nobody links to.
    """
    return _next_ranks(links, ranks, damping, missing)


def pagerank(
    edges: DataFrame,
    *,
    weight: str,
    iters: int = ITERATIONS,
    damping: float = DAMPING,
    num_partitions: int | None = None,
    cache: bool = True,
    cut_every: int = CUT_EVERY,
    snapshot_dir: str | None = None,
    missing: str = "null",
    heavy_rows: int = HEAVY_ROWS,
    result_path: str | None = None,
    exact: bool = False,
) -> DataFrame:
    """``iters`` rank steps from rank 1 everywhere, as ``(source, rank)``.

    Every ``cut_every`` iterations the ranks are written out, so no plan holds
    more joins than that and a lost executor costs at most that many steps; so are
    the last ones, to ``result_path`` if the caller wants to drop them later.
    With ``snapshot_dir`` they are published there, along with the last ones, and
    a later call over the same edges goes on from the newest it finds. Other edges have
    snapshots of their own in the same folder. ``cache`` keeps the laid-out links for
    the run; without it they are laid out anew after every cut. With ``snapshot_dir``
    the layout is kept there too, and a later call exchanges no links.

    With ``exact`` ranks are decimals and equal to the last digit whatever the
    partitions, the order or the restarts; a rank of 17 digits before the point is an
    error, and steps take longer.
    """
    spark = edges.sparkSession
    if iters == 0:
        start = init_ranks(edges)
        return start.withColumn("rank", F.col("rank").cast(EXACT_RANK)) if exact else start
    profile = profile_links(edges)
    saved = None
    if snapshot_dir is not None:
        kind = f"{weight}-{damping}-{missing}" + "-exact" * exact
        saved = f"{snapshot_dir}/{kind}-{profile.fingerprint}"
    done = (latest_step(spark, saved, at_most=iters) if saved else None) or 0
    ranks = read_step(spark, saved, done) if done else None
    if done == iters:
        return ranks

    options = {"weight": weight, "num_partitions": num_partitions, "heavy_rows": heavy_rows}
    links = None
    if saved:
        # of the same links, whatever the damping
        shape = f"{weight}-{num_partitions or 'auto'}-{heavy_rows}" + "-exact" * exact
        kept = f"{snapshot_dir}/links/{profile.fingerprint}-{shape}"
        links = open_layout(spark, kept, EXACT_LINK if exact else LINK)
    if links is None:
        links = lay_out(edges, profile=profile, exact=exact, **options)
        if saved:
            links = save_layout(links, kept)
    cache = cache and iters - done > 1  # a single step reads the links once
    if cache:
        for part in links.parts():
            part.persist(StorageLevel.MEMORY_AND_DISK)
    cut = None
    try:
        with shuffling_into(spark, links.partitions):
            for step in range(done + 1, iters + 1):
                ranks = _next_ranks(links, ranks, damping, missing, exact)
                due = step % cut_every == 0 or step == iters
                before = cut
                if saved and due:
                    ranks, cut = publish(ranks, saved, step), None
                # with two parts both read the ranks: from a table, not by two plans
                elif due or links.spread is not None:
                    cut = (step == iters and result_path) or new_folder(spark, "ranks")
                    ranks = freeze(ranks, "ranks", cut)
                else:
                    continue
                if before is not None:
                    drop_frozen(spark, before)
    finally:
        if cache:
            for part in links.parts():
                part.unpersist()
        links.drop()
    return ranks
