"""Deduplicating new batches against all history by multi-key sorted-neighbourhood runs.

Every record gets sort keys (amount and number, amount and date). A run holds the key rows of one batch, sorted, in key
ranges of about ``per_range`` rows (so there are more ranges as the history grows); each range is a folder named by its
least amount. A new batch reads only the ranges that its keys fall in, of them only the amounts between its least and
greatest, and only the rows whose key it has: its keys go out to the history's scan, which isn't shuffled (beyond
``broadcast_rows`` keys they are too many for that, and both sides are joined by key). These rows and the new ones are
merged in key order, and the windows around the new ones are compared. A window is not a count of rows but the span of
one key, so nothing is capped; a window that holds more than a fair share of all rows is split over several tasks.
Where there are more than ``most_runs`` runs they are merged into one.

The amount is in both keys, so the number of a framework order that a tenth of all records carry, or a frequent date,
does not make a large window. Exact copies of a record are one writing, which is compared once and never again; links
between writings and the membership of records are persisted, too: they are the result in compact form, and pairs of
records are made of them.

Defined results: records without a readable amount, or with neither number nor date, are in no pair; NULL and '' are
the same; records delivered repeatedly under other ids are pairs.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from datetime import date
from functools import lru_cache, reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from albaran.llm.graph import components
from albaran.llm.names import conflict, parse, similarity
from albaran.operators.timestamps import laid_out
from albaran.session import checkpoint_folder, cut, settle, ship

KEY = ("whole", "kind", "rest")
FIELDS = ("w", "supplier", "number", "day", "cents")


def amount_cents(c: Column) -> Column:
    """Hundredths of an amount in any writing; NULL where it can't be read."""
    s = F.regexp_replace(F.regexp_replace(c, r"^\s+|\s+$", ""), r"^(?:[A-Za-z]{1,3}[/$.]+|[A-Za-z]{2,4}(?=\s)|[$€£¥₹])\s*|(?:\s+[A-Za-z]{2,4}|\s*[$€£¥₹])$", "")
    s = F.regexp_replace(F.translate(s, "OolISB", "001158"), r"\s+", "")
    s = F.regexp_replace(s, r"^[.,]+|[.,\-]+$", "")
    # the last separator is decimal if it is followed by other than three digits, or if both kinds occur
    both = s.contains(".") & s.contains(",")
    dot_last = F.instr(F.reverse(s), ".") < F.instr(F.reverse(s), ",")
    us = F.translate(s, ",", "")
    eu = F.translate(F.translate(s, ".", ""), ",", ".")
    only_comma = s.contains(",") & ~s.contains(".")
    plain = (
        F.when(both, F.when(dot_last, us).otherwise(eu))
        .when(only_comma, F.when(s.rlike(r"^\d{1,3}(,\d{3})+$"), us).otherwise(eu))
        .when(s.rlike(r"^\d{1,3}(\.\d{3}){2,}$"), F.translate(s, ".", ""))
        .otherwise(s)
    )
    return F.when(plain.rlike(r"^\d{1,15}(\.\d+)?$"), F.round(plain.try_cast("decimal(30,6)") * 100, 0).cast("bigint"))


def number_key(c: Column) -> Column:
    """Digits of a document number after look-alike letters are read as digits; '' where there is none."""
    s = F.regexp_replace(F.upper(F.trim(c)), r"^(?:(?:N[ºO°]\.?|NO\.|NUM\.?|#|FACTURA|INVOICE|REF\.?|DOC\.?)\s*)+(?=\S)", "")
    s = F.regexp_replace(s, r"^OC\s?N[°º]?", "OC")
    return F.coalesce(F.regexp_replace(F.translate(s, "OIlLSB", "011158"), "[^0-9]", ""), F.lit(""))


def _local_day(rows: DataFrame, value: str, sites: DataFrame, site: str) -> DataFrame:
    """rows with the column `day`: the calendar day at the record's site as yyyy-MM-dd, '' where none can be read."""
    places = sites.select(F.col("site_code").alias("_ts_site"), F.col("tz_name").alias("_ts_tz"), F.col("date_order").alias("_ts_order")).dropDuplicates(["_ts_site"])
    df = rows.join(places, rows[site] == places["_ts_site"], "left")
    df = laid_out(df, value, "_ts_tz", "_ts_order", (1990, 2100), "_ts_out")
    at_site = F.from_utc_timestamp(F.timestamp_seconds(F.col("_ts_at")), F.coalesce(F.col("_ts_tz"), F.lit("UTC")))
    shifted = F.date_from_unix_date(F.floor(F.unix_seconds(at_site) / 86400).cast("int")).cast("string")
    wall = F.date_from_unix_date(F.col("_ts_day").cast("int")).cast("string")
    moved = (F.col("_ts_epoch").isNotNull() | F.col("_ts_off").isNotNull() | F.col("_ts_zone").isNotNull()) & F.col("_ts_tz").isNotNull()
    day = F.when(moved, shifted).otherwise(F.coalesce(wall, F.date_from_unix_date(F.col("_ts_date")).cast("string"), shifted))
    df = df.withColumn("day", F.coalesce(day, F.lit("")))
    return settle(df.drop(*[c for c in df.columns if c.startswith("_ts_")]), "day")


def prepare(records: DataFrame, sites: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The fields compared, in one writing: rec_id, supplier (as typed), number, day, cents; unreadable amounts left out."""
    df = records.select("rec_id", *keep, "site_code", "supplier", "issue_date", number_key(F.col("invoice_or_po_number")).alias("number"), amount_cents(F.col("total_amount")).alias("cents"))
    df = settle(df, "number", "cents").where(F.col("cents").isNotNull() & F.col("supplier").rlike(r"\p{L}"))
    return _local_day(df, "issue_date", sites, "site_code").select("rec_id", *keep, "supplier", "number", "day", "cents")


def sort_keys(df: DataFrame) -> DataFrame:
    """One row for each sort key of a record: (whole, kind, rest), the amount in whole units and the number or the day.

    Half up and half down both stand for an amount of exactly fifty hundredths, as either may be its rounded form.
    """
    low, high = F.floor((F.col("cents") + 49) / 100), F.floor((F.col("cents") + 50) / 100)
    key = lambda kind, c: F.when(F.col(c) != "", F.struct(F.lit(kind).alias("kind"), F.col(c).alias("rest")))
    df = df.withColumn("whole", F.explode(F.array_distinct(F.array(low, high)))).withColumn("_key", F.explode(F.array_compact(F.array(key("n", "number"), key("d", "day")))))
    return df.select("whole", "_key.kind", "_key.rest", *FIELDS)


@lru_cache(maxsize=200_000)
def same_supplier(a: str, b: str, least: float = 0.8) -> bool:
    p, q = parse(a), parse(b)
    return similarity(p, q) >= least or bool(p.core and q.core and not conflict(p, q) and similarity(p, q, 0.5) >= 0.7)


def same_document(a: tuple, b: tuple) -> bool:
    """Two writings (supplier, number, day, cents) of one document: at most one of number and day is missing in one."""
    (sa, na, da, ca), (sb, nb, db, cb) = a, b
    if ca != cb:
        if ca % 100 and cb % 100 or abs(ca - cb) > 50:
            return False
    if na and nb and na != nb:
        return False
    if da and db and da != db and not (na and nb and abs((date.fromisoformat(da) - date.fromisoformat(db)).days) <= 1):
        return False  # a day apart is a time near midnight, if the numbers are equal
    if not (na and nb) and not (da and db):
        return False
    return sa == sb or same_supplier(sa, sb)


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links within the windows: rows come sorted by key; `first` tells the rows around which the windows are.

    Records of equal number meet under that number, so a window of a day compares only those of which one has none.
    """
    key, numbered, bare = None, [], []
    for b in batches:
        out = []
        for *at, first, w, supplier, number, day, cents in zip(*(b[c] for c in (*KEY, "part", "first", *FIELDS))):
            if at != key:
                key, numbered, bare = at, [], []
            x = (supplier, number, day, cents)
            near = (numbered, bare) if at[1] == "n" or not number else (bare,)
            for rows in near:
                for other, v, y in rows:
                    if (first or other) and w != v and same_document(x, y):
                        out.append((min(v, w), max(v, w)))
            (numbered if number else bare).append((first, w, x))
        yield pd.DataFrame(out, columns=["a_w", "b_w"])


def writings(df: DataFrame) -> DataFrame:
    """df with w, the hash of supplier, number, day and cents: exact copies have the same."""
    return df.withColumn("w", F.sha2(F.concat_ws("\u0001", "supplier", "number", "day", "cents"), 256))


def windows(new: DataFrame, near: DataFrame | None = None, least_hot: int = 4_000) -> DataFrame:
    """Links (a_w, b_w) of different writings of one document within the windows around the rows of `new`.

    new, near: key rows (near: those of the history that have a key of new). A key with more rows than both `least_hot`
    and a ten-thousandth of all is hot: there are at most 10,000 such keys, so they are broadcast. Its new rows are
    dealt out to parts, and the rows of its window go to every part.
    """
    ship(new.sparkSession)
    rows = new.withColumn("first", F.lit(True))
    if near is not None:
        rows = rows.unionByName(near.withColumn("first", F.lit(False)))
    rows = cut(rows)
    sizes = rows.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"))
    hot = sizes.where(F.col("n") > max(least_hot, rows.count() / 10_000)).collect()
    rows = rows.withColumn("part", F.lit(0))
    if hot:
        parts = new.sparkSession.createDataFrame([(*r[:3], -(-r["n"] // least_hot)) for r in hot], "whole long, kind string, rest string, parts int")
        rows = rows.join(F.broadcast(parts), list(KEY), "left")
        own = F.pmod(F.xxhash64("w"), F.coalesce("parts", F.lit(1))).cast("int")
        rows = rows.withColumn("_own", own).withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("parts") - 1, F.lit(0)))))
        rows = rows.withColumn("first", F.col("first") & (F.col("part") == F.col("_own")))
    rows = rows.select(*KEY, "part", "first", *FIELDS).repartition(*KEY, "part").sortWithinPartitions(*KEY, "part", "w")
    return rows.mapInPandas(_compare, "a_w string, b_w string").distinct()


def _expand(links: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs (rec_a < rec_b) of a record of left and one of right (w, rec_id): copies, and records of linked writings."""
    a, b = left.select("w", F.col("rec_id").alias("x")), right.select("w", F.col("rec_id").alias("y"))
    both = links.select(F.col("a_w").alias("w"), F.col("b_w").alias("to")).union(links.select("b_w", "a_w"))
    across = a.join(both, "w").select("x", F.col("to").alias("w")).join(b, "w").select("x", "y")
    pairs = across.union(a.join(b, "w").where("x <> y").select("x", "y"))
    return pairs.select(F.least("x", "y").alias("rec_a"), F.greatest("x", "y").alias("rec_b")).where("rec_a < rec_b").distinct()


def _rows(records: DataFrame, sites: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return writings(prepare(records, sites, keep).where("number <> '' or day <> ''"))


def pairs_of(records: DataFrame, sites: DataFrame) -> DataFrame:
    """All pairs (rec_a < rec_b) of records of one document, over the whole history at once."""
    rows = cut(_rows(records, sites))
    members = rows.select("w", "rec_id")
    return _expand(windows(sort_keys(rows.dropDuplicates(["w"]))), members, members)


def _filled(records: DataFrame, sites: DataFrame, load: str, batches: int) -> RunStore:
    """A store in the checkpoint folder that took the loads in `batches` ranges of their numbers, in order.

    The records are read and prepared once; rows without a load number come first. What is found doesn't depend on how
    the loads are grouped.
    """
    spark = records.sparkSession
    store = RunStore(spark, f"{checkpoint_folder(spark)}/runs-{uuid.uuid4().hex}", most_runs=2)
    rows = cut(_rows(records, sites, (load,)))
    low, high = rows.agg(F.min(load), F.max(load)).first()
    if low is None or low == high:
        store.accept(rows.drop(load))
        return store
    n = F.least(F.lit(batches - 1), F.floor((F.coalesce(F.col(load), F.lit(low)) - low) * batches / (high - low + 1)))
    for i in range(batches):
        store.accept(rows.where(n == i).drop(load))
    return store


def pairs_by_batches(records: DataFrame, sites: DataFrame, load: str = "load_id", batches: int = 4) -> DataFrame:
    """The pairs of pairs_of, found batch by batch through persisted runs; the runs are removed afterwards."""
    store = _filled(records, sites, load, batches)
    out = cut(store.pairs())
    store.remove()
    return out


def classes_by_batches(records: DataFrame, sites: DataFrame, load: str = "load_id", batches: int = 4) -> DataFrame:
    """(rec_id, cls, copies): each record with its class, named by its least record, and the number of its records.

    The compact form of the pairs: as many rows as there are records with a key. Records are one class if links lead
    from one to the other.
    """
    store = _filled(records, sites, load, batches)
    of = components(store.links().select(F.col("a_w").alias("src"), F.col("b_w").alias("dst")))
    rows = store.members().join(of.withColumnRenamed("node", "w"), "w", "left").select("rec_id", F.coalesce("component", "w").alias("c"))
    each = rows.groupBy("c").agg(F.min("rec_id").alias("cls"), F.count(F.lit(1)).alias("copies"))
    out = cut(rows.join(each, "c").select("rec_id", "cls", "copies"))
    store.remove()
    return out


class RunStore:
    """Persisted runs, links and members in a shared folder, as Parquet.

    accept(rows) finds the links between a batch and everything accepted, and accepts it; add(records, sites) gives the
    pairs that came with it, too. Every folder has a number and a random name, so two writers never write to one; a
    folder counts once it is whole (_SUCCESS).
    """

    RUN = "whole bigint, kind string, rest string, w string, supplier string, number string, day string, cents bigint, lo bigint"

    def __init__(self, spark: SparkSession, folder: str, per_range: int = 1_000_000, most_runs: int = 8, broadcast_rows: int = 500_000):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.per_range, self.most_runs, self.broadcast_rows = per_range, most_runs, broadcast_rows

    def _path(self, of: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(of)

    def _list(self, folder: str, prefix: str) -> list[str]:
        path = self._path(folder)
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return sorted(x.getPath().toString() for x in fs.listStatus(path) if x.getPath().getName().startswith(prefix)) if fs.exists(path) else []

    def _whole(self, kind: str) -> list[str]:
        return [x for x in self._list(self.folder, f"{kind}-") if self._list(x, "_SUCCESS")]

    def _new(self, kind: str) -> str:
        last = max((int(x.rsplit("/", 1)[1].split("-")[1]) for x in self._list(self.folder, f"{kind}-")), default=0)
        return f"{self.folder}/{kind}-{last + 1:06d}-{uuid.uuid4().hex}"

    def _read(self, kind: str, schema: str) -> DataFrame:
        folders = self._whole(kind)
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def runs(self) -> list[str]:
        return self._whole("run")

    def links(self) -> DataFrame:
        """(a_w, b_w) of all linked writings."""
        return self._read("links", "a_w string, b_w string")

    def members(self) -> DataFrame:
        """(w, rec_id) of all records accepted."""
        return self._read("members", "w string, rec_id bigint")

    def pairs(self) -> DataFrame:
        """All pairs (rec_a < rec_b)."""
        m = self.members()
        return _expand(self.links(), m, m)

    def _range(self, los: list[int]) -> Column:
        """The range an amount is in: the greatest bound that isn't above it (the first range for all below)."""
        return F.coalesce(F.try_element_at(F.filter(F.array(*[F.lit(x).cast("bigint") for x in los]), lambda x: x <= F.col("whole")), F.lit(-1)), F.lit(los[0]).cast("bigint"))

    def _write(self, rows: DataFrame) -> None:
        n = -(-rows.count() // self.per_range)
        los = sorted({int(x) for x in rows.approxQuantile("whole", [i / n for i in range(n)], 0.001)}) if n else [0]
        # a range that holds more than its share is several files, each sorted and with bounds of its own
        sorted_ = rows.withColumn("lo", self._range(los)).repartitionByRange(max(1, n), "lo", *KEY, "w").sortWithinPartitions("lo", *KEY, "w")
        sorted_.write.partitionBy("lo").parquet(self._new("run"))

    def _near(self, new: DataFrame) -> DataFrame | None:
        """The history's rows with a key of new."""
        keys = new.select(*KEY).distinct()
        least, greatest, n = new.agg(F.min("whole"), F.max("whole"), F.count(F.lit(1))).first()
        parts = []
        for run in self.runs():
            los = sorted(int(x.rsplit("lo=", 1)[1]) for x in self._list(run, "lo="))
            if not los or n == 0:
                continue
            touched = [r[0] for r in new.select(self._range(los)).distinct().collect()]  # at most the ranges of a run
            parts.append(self.spark.read.schema(self.RUN).parquet(run).where(F.col("lo").isin(touched) & F.col("whole").between(least, greatest)).drop("lo"))
        if not parts:
            return None
        old = reduce(DataFrame.unionByName, parts)
        return old.join(F.broadcast(keys) if n <= self.broadcast_rows else keys, list(KEY), "left_semi")

    def accept(self, rows: DataFrame) -> None:
        """rows: (rec_id, supplier, number, day, cents, w) of a batch."""
        new = sort_keys(rows.dropDuplicates(["w"]))
        near = self._near(cut(new)) if self.runs() else None
        if near is not None:
            near = cut(near)
            new = new.join(near.select("w").distinct(), "w", "left_anti").select(*KEY, *FIELDS)
        new = cut(new)
        windows(new, near).write.parquet(self._new("links"))
        rows.select("w", "rec_id").write.parquet(self._new("members"))
        self._write(new)
        if len(self.runs()) > self.most_runs:
            self.compact()

    def add(self, batch: DataFrame, sites: DataFrame) -> DataFrame:
        """The pairs (rec_a < rec_b) between the batch and everything accepted, and within it; the batch is accepted."""
        rows = cut(_rows(batch, sites))
        self.accept(rows)
        return cut(_expand(self.links(), rows, self.members()))

    def _delete(self, folder: str) -> None:
        path = self._path(folder)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def remove(self) -> None:
        """Everything away."""
        self._delete(self.folder)

    def compact(self) -> None:
        """All runs into one with ranges of its own; the old ones are removed after the new one is whole."""
        runs = self.runs()
        if len(runs) > 1:
            self._write(reduce(DataFrame.unionByName, [self.spark.read.schema(self.RUN).parquet(r).drop("lo") for r in runs]))
            for r in runs:
                self._delete(r)
