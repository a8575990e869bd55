"""Mixing sources to target weights by iterative proportional fitting.

The token weights of the cells (source, language, topic) are raked to three marginals: each source's target share of
the mix, and the languages' and topics' shares as they are in the corpus. A source can give at most its tokens times
``max_repeats``; the size of the mix is the largest at which every source that has any tokens reaches its share
(or ``total``, where given). Documents are then drawn by the calibrated number of copies of their cell: the whole part
for every document, the rest by the order of the documents' hashes up to the cell's share of tokens.

The cells are few whatever the corpus (sources of the target list x 8 languages x the topics of a fixed list), so the
raking is done on the driver; all sizes are sums over all documents.

Defined results: documents of no target source, with NULL source, or without tokens are not drawn; sources without
documents are reported with the share 0 and their share goes to the others in proportion.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from albaran.functions.lookup import lookup
from albaran.llm.language import LABEL_OF
from albaran.llm.tokens import token_counts
from albaran.session import cut, spread

TOPICS = ("clean", "scanned", "specification", "edge")
BINS = 512


def language_cell(label: Column) -> Column:
    """The label as one of seven codes or 'other'."""
    s = F.lower(F.trim(F.coalesce(label, F.lit(""))))
    return F.coalesce(lookup(LABEL_OF, s), lookup(LABEL_OF, F.split(s, "[-_ (]").getItem(0)), F.lit("other"))


def rake(tokens: np.ndarray, marginals: list[np.ndarray], most: np.ndarray, rounds: int = 200, close: float = 1e-9) -> np.ndarray:
    """Weights of the cells (array of any rank) whose sums along each axis go to the marginals.

    No cell may exceed tokens * most (by source, the first axis). The first marginal is fitted last in each round, so
    it holds exactly as far as the caps allow; what a capped cell can't take goes to the source's other cells.
    """
    w = tokens.astype(float).copy()
    cap = tokens * most.reshape(-1, *[1] * (tokens.ndim - 1))
    for _ in range(rounds):
        before = w.copy()
        for axis in [*range(1, tokens.ndim), 0]:
            others = tuple(i for i in range(tokens.ndim) if i != axis)
            for _ in range(30 if axis == 0 else 1):
                now = w.sum(axis=others)
                f = np.divide(marginals[axis], now, out=np.ones_like(now), where=now > 0)
                w = np.minimum(w * f.reshape([-1 if i == axis else 1 for i in range(tokens.ndim)]), cap)
                if axis or np.allclose(w.sum(axis=others), marginals[0], rtol=1e-9):
                    break
        if np.abs(w - before).max() <= close * max(1.0, w.max()):
            break
    return w


@dataclass
class Plan:
    """Calibrated copies by cell, and what the mix is to hold of each source."""

    sources: list[str]
    share: np.ndarray
    repeats: np.ndarray
    langs: list[str]
    topics: list[str]
    tokens: np.ndarray
    weights: np.ndarray
    total: float
    aims: list[np.ndarray]


def plan_mix(cells: list[tuple[str, str, str, int]], targets: list[tuple[str, float, int]], total: float | None = None) -> Plan:
    sources = [t[0] for t in targets]
    share = np.array([float(t[1] or 0) for t in targets])
    repeats = np.array([float(t[2] or 0) for t in targets])
    langs, topics = sorted({c[1] for c in cells}) or ["other"], sorted({c[2] for c in cells}) or ["other"]
    tokens = np.zeros((len(sources), len(langs), len(topics)))
    for s, lang, topic, n in cells:
        tokens[sources.index(s), langs.index(lang), topics.index(topic)] += n
    have = tokens.sum(axis=(1, 2))
    live = (have > 0) & (share > 0) & (repeats > 0)
    aim = np.where(live, share, 0.0)
    aim = aim / aim.sum() if aim.sum() else aim
    reach = min((have[i] * repeats[i] / aim[i] for i in range(len(sources)) if live[i]), default=0.0)
    size = reach if total is None else float(total)
    by_source = np.minimum(aim * size, have * repeats)
    size = by_source.sum()
    by_lang, by_topic = (tokens[live].sum(axis=(0, 2)), tokens[live].sum(axis=(0, 1)))
    scale = tokens[live].sum() or 1.0
    w = rake(np.where(live[:, None, None], tokens, 0), [by_source, by_lang / scale * size, by_topic / scale * size], repeats) if size else tokens * 0
    aims = [by_source / (size or 1.0), by_lang / scale, by_topic / scale]
    return Plan(sources, share, repeats, langs, topics, tokens, w, size, aims)


def sized(docs: DataFrame, targets: DataFrame, key: str, text: str, source: str, lang: str, topic: str, path: str | None) -> DataFrame:
    """(key, source, lang, topic, tokens, bin) of the documents of the target sources, cut by a checkpoint."""
    wanted = [r[0] for r in targets.select("source").collect()]  # a fixed table
    of = docs.where(F.col(source).isin(wanted))
    of = token_counts(spread(of).select(key, text, source, lang, topic), [key, source, lang, topic], text, path)
    cell = F.when(F.col(topic).isin(*TOPICS), F.col(topic)).otherwise(F.lit("other"))
    place = F.xxhash64(F.col(key).cast("string"))
    out = of.select(
        F.col(key).alias("doc_id"), F.col(source).alias("source"), language_cell(F.col(lang)).alias("lang"), cell.alias("topic"), "tokens",
        F.shiftrightunsigned(place, 55).cast("int").alias("bin"), place.alias("place"),
    )
    return cut(out.where("tokens > 0"))


def mix(
    docs: DataFrame, targets: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang", topic: str = "category",
    path: str | None = None, total: float | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(the mix: doc_id, source, lang, topic, tokens, copies; the report by source; the report by marginal).

    The report by source has the targets and what was reached; the one by marginal (marginal, value, target_share,
    raked_share, actual_share) has for each source, language and topic the share aimed at, that of the raked weights
    (equal to it where the raking converged) and that of the documents drawn.
    """
    spark = docs.sparkSession
    rows = sized(docs, targets, key, text, source, lang, topic, path)
    # sums by cell and hash bin: at most cells * BINS rows, whatever the corpus
    bins = rows.groupBy("source", "lang", "topic", "bin").agg(F.sum("tokens").alias("tokens")).toPandas()
    goal = [(r["source"], r["target_share"], r["max_repeats"]) for r in targets.select("source", "target_share", "max_repeats").collect()]
    cells: dict[tuple[str, str, str], np.ndarray] = {}
    for cell, part in bins.groupby(["source", "lang", "topic"]):
        cells[cell] = np.bincount(part["bin"], part["tokens"], BINS).astype(np.int64)
    plan = plan_mix([(*c, int(h.sum())) for c, h in cells.items()], goal, total)
    take = []
    for i, s in enumerate(plan.sources):
        # what rounding left over in one cell is owed to the next cell of the source
        owed = 0.0
        for (cs, lang_, topic_), h in sorted(cells.items()):
            if cs != s:
                continue
            n = h.sum()
            want = plan.weights[i, plan.langs.index(lang_), plan.topics.index(topic_)] + owed
            want = min(max(want, 0.0), n * plan.repeats[i])
            whole = int(want // n) if n else 0
            run = np.concatenate([[0], np.cumsum(h)])
            upto = int(np.abs(run - (want - whole * n)).argmin()) if whole < plan.repeats[i] else 0
            owed = want - whole * n - run[upto]
            take.append((cs, lang_, topic_, whole, upto))
    marks = spark.createDataFrame(take, "source string, lang string, topic string, whole int, upto int")
    copies = F.col("whole") + F.when(F.col("bin") < F.col("upto"), 1).otherwise(0)
    drawn = rows.join(F.broadcast(marks), ["source", "lang", "topic"]).withColumn("copies", copies.cast("int"))
    drawn = drawn.where("copies > 0").select("doc_id", "source", "lang", "topic", "tokens", "copies")
    got = drawn.groupBy("source").agg(
        F.count(F.lit(1)).alias("documents"), F.sum("copies").alias("copies"), F.max("copies").alias("repeats"), F.sum(F.col("tokens") * F.col("copies")).alias("mixed_tokens")
    )
    have = rows.groupBy("source").agg(F.sum("tokens").alias("source_tokens"))
    all_ = got.agg(F.sum("mixed_tokens").alias("all_tokens"))
    zero = lambda c, t="bigint": F.coalesce(F.col(c), F.lit(0)).cast(t).alias(c)
    report = (
        targets.select("source", "target_share", "max_repeats").join(have, "source", "left").join(got, "source", "left").crossJoin(F.broadcast(all_))
        .select(
            "source", "target_share", "max_repeats", zero("source_tokens"), zero("documents"), zero("copies"), zero("repeats", "int"), zero("mixed_tokens"),
            F.coalesce(F.try_divide(F.col("mixed_tokens"), F.col("all_tokens")), F.lit(0.0)).alias("actual_share"),
        )
    )
    sums = {"source": plan.weights.sum(axis=(1, 2)), "lang": plan.weights.sum(axis=(0, 2)), "topic": plan.weights.sum(axis=(0, 1))}
    all_weight = plan.weights.sum() or 1.0
    aims = [
        (m, v, float(a), float(w / all_weight))
        for m, values, aim in (("source", plan.sources, plan.aims[0]), ("lang", plan.langs, plan.aims[1]), ("topic", plan.topics, plan.aims[2]))
        for v, a, w in zip(values, aim, sums[m])
    ]
    goals = spark.createDataFrame(aims, "marginal string, value string, target_share double, raked_share double")
    weight = F.sum(F.col("tokens") * F.col("copies"))
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("marginal"), F.col(m).alias("value")) for m in sums]))
    reached = drawn.select(each.alias("x"), "tokens", "copies").groupBy("x.marginal", "x.value").agg(weight.alias("n"))
    marginals = goals.join(reached, ["marginal", "value"], "left").crossJoin(F.broadcast(all_)).select(
        "marginal", "value", "target_share", "raked_share", F.coalesce(F.try_divide(F.col("n"), F.col("all_tokens")), F.lit(0.0)).alias("actual_share")
    )
    return drawn, report, marginals
