"""Clusters of off-script messages: medoids, density clusters per bucket, summaries."""

from __future__ import annotations

import functools
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import domain
from ..functions.text import stripped
from ..storage import saved
from .graph import components
from .ordered import with_parent_step
from .relational import numbered
from .templates import top_values

#: Dimensions of an embedded text, and vectors of a block that is compared at once.
DIMS, BLOCK = 384, 2048
#: Blocks that a group has while they are smaller than ``BLOCK``.
FEW_BLOCKS = 16


def medoids(vectors: DataFrame, group: str, key: str, vector: str) -> DataFrame:
    """The member of each group with the least sum of cosine distances, the first on ties.

    The sum of cosines with all members is the product with the sum of unit vectors: one sum of
    vectors for each group, made map-side first, and no pairs.
    """
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    unit = vectors.withColumn("_n", F.when(norm == 0, 1.0).otherwise(norm)).withColumn("_u", F.transform(vector, lambda x: x.cast("double") / F.col("_n")))
    total = unit.groupBy(group).agg(Summarizer.sum(array_to_vector("_u")).alias("_s"), F.count(F.lit(1)).alias("size")).select(group, "size", vector_to_array("_s").alias("_t"))
    cost = unit.join(total, group).withColumn("_c", F.round(-F.aggregate(F.zip_with("_u", "_t", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x), 9))
    return cost.groupBy(group).agg(F.min_by(key, F.struct("_c", key)).alias("medoid"), F.max("size").alias("size"))


def _distances(vectors: pd.Series) -> np.ndarray:
    """Cosine distances of all pairs. Nine digits: what is equal is equal in whatever block it is met."""
    x = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    size = np.linalg.norm(x, axis=1)
    u = x / np.where(size == 0, 1, size)[:, None]
    d = u @ u.T
    return np.round(np.maximum(np.subtract(1, d, out=d), 0, out=d), 9, out=d)


def _tree(d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A least spanning tree of a matrix of distances (Prim): two ends and the distance of each edge."""
    n = len(d)
    best, parent, outside = d[0].copy(), np.zeros(n, dtype=int), np.ones(n, dtype=bool)
    outside[0] = False
    new = np.zeros(n - 1, dtype=int)
    for k in range(n - 1):
        at = int(np.where(outside, best, np.inf).argmin())
        new[k], outside[at] = at, False
        closer = outside & (d[at] < best)
        best[closer], parent[closer] = d[at][closer], at
    return new, parent[new], best[new]


def _blocks(rows: DataFrame, group: str, key: str, block: int) -> DataFrame:
    """``rows`` dealt to pairs of blocks ``_x <= _y`` of their group, so that every two rows of a group meet.

    Groups of one block meet in it; of more, only different blocks meet, which holds the pairs inside a block too.
    """
    # A row is copied once a block: blocks grow with the group, up to what one task may hold.
    n = F.count(F.lit(1))
    size = F.greatest(F.lit(block), F.least(F.ceil(n / FEW_BLOCKS), F.lit(BLOCK)))
    sizes = rows.groupBy(group).agg(F.ceil(n / size).cast("int").alias("_k")).withColumnRenamed(group, "_of")
    placed = rows.join(sizes, F.col(group).eqNullSafe(F.col("_of"))).withColumn("_b", F.pmod(F.xxhash64(key), F.col("_k")).cast("int"))
    other = F.filter(F.sequence(F.lit(0), F.col("_k") - 1), lambda o: (o != F.col("_b")) | (F.col("_k") == 1))
    met = placed.withColumn("_o", F.explode(other))
    return met.select(*rows.columns, F.least("_b", "_o").alias("_x"), F.greatest("_b", "_o").alias("_y"), (F.col("_k") > 1).alias("_many"))


def least_tree(edges: DataFrame) -> DataFrame:
    """The edges of a least spanning forest of ``edges(a, b, w)``, by Boruvka rounds.

    In a round every component takes its least edge outwards (ties by its ends, so no cycle arises),
    components that took the same edges become one, and edges inside one are dropped. So the
    components at least halve; each round is a stored table.
    """
    left = saved(edges.select("a", "b", "w", F.col("a").alias("ca"), F.col("b").alias("cb")), "tree-edges")
    taken: list[DataFrame] = []
    while not left.isEmpty():
        ends = left.select(F.col("ca").alias("c"), "w", "a", "b", "ca", "cb").union(left.select("cb", "w", "a", "b", "ca", "cb"))
        least = ends.groupBy("c").agg(F.min(F.struct("w", "a", "b", "ca", "cb")).alias("e"))
        chosen = saved(least.select("e.*").distinct(), "tree-taken")
        taken.append(chosen.select("a", "b", "w"))
        now = components(chosen.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
        for c in ("ca", "cb"):
            left = left.join(now.select(F.col("id").alias(c), F.col("component").alias("_now")), c, "left").withColumn(c, F.coalesce("_now", c)).drop("_now")
        left = saved(left.filter("ca <> cb"), "tree-edges")
    return functools.reduce(DataFrame.union, taken) if taken else edges.select("a", "b", "w")


def spanning_tree(vectors: DataFrame, group: str, key: str, vector: str, block: int = BLOCK) -> DataFrame:
    """``group, a, b, w``: a least spanning tree of each group by cosine distance, over the numbers ``key``.

    A group is dealt to pairs of blocks, and each pair keeps its own least tree. What these drop
    closes a cycle of edges no longer than it, so the union of the small trees spans each group at
    every distance as all pairs do, and holds a least tree of it: that is found by rounds over
    edges. Groups of one block have theirs at once.
    """
    met = _blocks(vectors.filter(F.col(vector).isNotNull()).select(group, key, vector), group, key, block // 2)
    kind = dict(vectors.dtypes)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        ids = pdf[key].to_numpy()
        one, other, w = _tree(_distances(pdf[vector]))
        a, b = np.minimum(ids[one], ids[other]), np.maximum(ids[one], ids[other])
        return pd.DataFrame({group: pd.Series([pdf[group].iloc[0]] * len(w), dtype=pdf[group].dtype), "a": a, "b": b, "w": w, "many": bool(pdf["_many"].iloc[0])})

    found = saved(met.groupBy(group, "_x", "_y").applyInPandas(run, f"{group} {kind[group]}, a long, b long, w double, many boolean"), "tree-parts")
    large = found.filter("many").drop("many").distinct()
    of = large.groupBy("a", "b").agg(F.first(group).alias(group))
    merged = least_tree(large.select("a", "b", "w")).join(of, ["a", "b"])
    return found.filter("not many").drop("many").unionByName(merged)


def _condensed(one: np.ndarray, other: np.ndarray, w: np.ndarray, n: int, least: int) -> np.ndarray:
    """Density clusters by excess of mass (Campello et al. 2013) from a tree over 0 to n - 1, -1 for noise.

    Merges at equal distance are one, so the result doesn't hang on which of several least trees it is.
    """
    root = np.arange(n)

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return int(i)

    node, size, kids, height = list(range(n)), [1] * n, {}, {}
    order = np.argsort(w, kind="stable")
    cuts = np.flatnonzero(np.diff(w[order])) + 1
    for level in np.split(order, cuts) if len(order) else []:
        parts: dict[int, list[int]] = {}
        for e in level.tolist():
            ra, rb = find(one[e]), find(other[e])
            if ra != rb:
                root[ra] = rb
                parts[rb] = parts.pop(rb, [node[rb]]) + parts.pop(ra, [node[ra]])
        for r, joined in parts.items():
            kids[len(size)], height[len(size)] = joined, max(float(w[level[0]]), 1e-12)
            node[r] = len(size)
            size.append(sum(size[c] for c in joined))
    top = len(size) - 1
    # Condense: a split counts when two sides or more are large enough.
    birth, stable, below = {top: 0.0}, {top: 0.0}, {top: []}
    todo = [(top, top)]
    while todo:
        i, cluster = todo.pop()
        if i < n:
            continue
        lam, big = 1 / height[i], [c for c in kids[i] if size[c] >= least]
        if len(big) >= 2:
            stable[cluster] += (lam - birth[cluster]) * size[i]
            for c in big:
                birth[c], stable[c], below[c] = lam, 0.0, []
                below[cluster].append(c)
                todo.append((c, c))
        else:
            stable[cluster] += (lam - birth[cluster]) * sum(size[c] for c in kids[i] if size[c] < least)
            todo += [(c, cluster) for c in big]
    whole = set()
    for c in sorted(birth):  # what is below has smaller numbers
        under = sum(stable[k] for k in below[c])
        if c != top and (not below[c] or stable[c] >= under):
            whole.add(c)
        else:
            stable[c] = under
    chosen, todo = [], list(below[top])
    while todo:
        c = todo.pop()
        if c in whole:
            chosen.append(c)
        else:
            todo += below[c]
    out = np.full(n, -1)
    for c in chosen:
        todo = [c]
        while todo:
            j = todo.pop()
            if j < n:
                out[j] = c
            else:
                todo += kids[j]
    # Clusters are numbered by their first member.
    names, first = np.unique(out[out >= 0], return_index=True)
    rank = dict(zip(names[np.argsort(first)].tolist(), range(len(names)), strict=True))
    return np.array([rank.get(c, -1) for c in out.tolist()], dtype=int)


def density_clusters(vectors: DataFrame, group: str, key: str, vector: str, least: int = domain.MIN_CLUSTER, block: int = BLOCK) -> DataFrame:
    """``group, key, cluster`` with noise -1, each bucket on its own; clusters are numbered by their first member.

    With one neighbour, the core distance of a member is never more than its distance to any other,
    so mutual reachability is the distance itself. Distances of a bucket are many tasks, and its
    tree is rounds over edges; a task then condenses a bucket's tree, three numbers a member. Null
    vectors are noise.
    """
    rows = saved(numbered(vectors.select(group, key, vector), [F.col(group), F.col(key)], "_v"), "density-rows")
    tree = spanning_tree(rows, group, "_v", vector, block)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, at = np.unique(pdf[["a", "b"]].to_numpy(), return_inverse=True)
        at = at.reshape(-1, 2)
        return pd.DataFrame({"_v": ids, "_c": _condensed(at[:, 0], at[:, 1], pdf["w"].to_numpy(), len(ids), least)})

    found = tree.groupBy(group).applyInPandas(run, "_v long, _c int")
    return rows.join(found, "_v", "left").select(group, key, F.coalesce("_c", F.lit(-1)).alias("cluster"))


def embedded(texts: DataFrame, key: str, dims: int = DIMS) -> DataFrame:
    """``key, vector``: hashed character n-grams of one to four letters, as an offline stand-in for a sentence model.

    The same text always gives the same vector, of length one; a blank text gives zeros. Another
    embedder is any function from ``texts(key, text)`` to ``key, vector``.
    """

    @F.pandas_udf("array<float>")
    def vectors(batch: pd.Series) -> pd.Series:
        out = []
        for text in batch:
            t = f" {(text or '').lower().strip()} "
            v = np.zeros(dims, dtype=np.float32)
            for n in range(1, 5):
                for i in range(len(t) - n + 1 if t.strip() else 0):
                    h = zlib.crc32(t[i : i + n].encode("utf-8", "surrogatepass"))
                    v[h % dims] += 1 if h >> 31 else -1
            size = float(np.linalg.norm(v))
            out.append((v / size if size else v).tolist())
        return pd.Series(out)

    return texts.select(key, vectors("text").alias("vector"))


#: Hashed features of a text, dimensions that are learned, and rounds that sharpen them.
FEATURES, LEARNED_DIMS, ROUNDS, GRAMS = 1 << 12, 64, 2, (3, 5)


def _features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, hashed feature and logarithmic count of the words' character n-grams of each text, words set off by blanks."""
    low = [f" {' '.join((t or '').lower().split())} " if (t or "").strip() else "" for t in texts]
    code = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    row = np.repeat(np.arange(len(low)), [len(t) for t in low])
    found = []
    with np.errstate(over="ignore"):
        h = np.zeros(len(code), dtype=np.uint64)
        for n in range(1, GRAMS[1] + 1):
            m = len(code) - n + 1
            if m <= 0:
                break
            h = h[:m] * np.uint64(0x100000001B3) + code[n - 1 :] + np.uint64(n)
            if n >= GRAMS[0]:
                inside = row[:m] == row[n - 1 :]
                mixed = (h[inside] ^ (h[inside] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                found.append(row[:m][inside] * FEATURES + (mixed >> np.uint64(52)).astype(np.int64))
    keys, n = np.unique(np.concatenate(found) if found else np.zeros(0, np.int64), return_counts=True)
    return keys // FEATURES, keys % FEATURES, 1 + np.log(n)


def learned_embedder(corpus: DataFrame, dims: int = LEARNED_DIMS, rounds: int = ROUNDS, seed: int = 7) -> Callable[[DataFrame, str], DataFrame]:
    """An embedder as ``embedded``, learned from ``corpus(text)``: TF-IDF n-grams on their main directions.

    The directions are those of a randomised singular value decomposition: each round every task
    sums, over its texts, the products of a text's features and its present place, and the sum is made
    orthogonal again. So texts whose words stand together elsewhere come near each other even if
    they share none. The driver holds ``FEATURES`` x ``dims`` numbers at any size of the corpus.
    """

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, n = np.zeros(FEATURES, dtype=np.int64), 0
        for batch in batches:
            df += np.bincount(_features(batch["text"].tolist())[1], minlength=FEATURES)
            n += len(batch)
        yield pd.DataFrame({"feature": np.append(np.arange(FEATURES), -1), "n": np.append(df, n)})

    texts = corpus.select("text")
    counts = {r["feature"]: r["n"] for r in texts.mapInPandas(counted, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()}
    n = counts.pop(-1, 0)
    idf = np.log((1 + n) / (1 + np.array([counts.get(i, 0) for i in range(FEATURES)]))) + 1

    def placed(texts_: list[str | None], basis: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Rows, features and weights of texts of length one, and each text's place."""
        row, feature, count = _features(texts_)
        weight = count * idf[feature]
        size = np.sqrt(np.bincount(row, weights=weight * weight, minlength=len(texts_)))
        weight = weight / size[row]
        place = np.zeros((len(texts_), basis.shape[1]))
        for k in range(basis.shape[1]):
            place[:, k] = np.bincount(row, weights=weight * basis[feature, k], minlength=len(texts_))
        return row, feature, weight, place

    basis = np.linalg.qr(np.random.default_rng(seed).normal(size=(FEATURES, dims)))[0]
    for k in range(rounds + 1):

        def summed(batches: Iterator[pd.DataFrame], basis: np.ndarray = basis) -> Iterator[pd.DataFrame]:
            total = np.zeros_like(basis)
            for batch in batches:
                row, feature, weight, place = placed(batch["text"].tolist(), basis)
                for k in range(basis.shape[1]):
                    total[:, k] += np.bincount(feature, weights=weight * place[row, k], minlength=FEATURES)
            yield pd.DataFrame({"feature": np.arange(FEATURES), "v": list(total)})

        sums = texts.mapInPandas(summed, "feature long, v array<double>").groupBy("feature").agg(vector_to_array(Summarizer.sum(array_to_vector("v"))).alias("v")).collect()
        total = np.zeros_like(basis)
        for r in sums:
            total[r["feature"]] = r["v"]
        if k < rounds:
            basis = np.linalg.qr(total)[0]
    # Directions by how much of the corpus lies along them: what often stands together counts most.
    strength, turn = np.linalg.eigh(basis.T @ total)
    basis = basis @ turn * np.sqrt(np.maximum(strength, 0))

    def embed(asked: DataFrame, key: str) -> DataFrame:
        @F.pandas_udf("array<float>")
        def vectors(batch: pd.Series) -> pd.Series:
            place = placed(batch.tolist(), basis)[3]
            size = np.linalg.norm(place, axis=1, keepdims=True)
            return pd.Series(list((place / np.where(size == 0, 1, size)).astype(np.float32)))

        return asked.select(key, vectors("text").alias("vector"))

    return embed


def summaries(clustered: DataFrame, vectors: DataFrame, texts: DataFrame, group: str, key: str, vector: str) -> DataFrame:
    """``group, cluster, medoid_text, size, example_msg_ids, rank`` of each cluster, without noise.

    Examples are the first by ``key``, ranked before they are gathered; ``rank`` is by size, the
    largest first, then by cluster.
    """
    rows = clustered.filter("cluster >= 0").withColumn("_cluster", F.struct(group, "cluster"))
    best = medoids(rows.join(vectors.select(key, vector), key), "_cluster", key, vector)
    place = F.row_number().over(Window.partitionBy("_cluster").orderBy(key))
    few = rows.withColumn("_r", place).filter(F.col("_r") <= domain.EXAMPLES)
    examples = few.groupBy("_cluster").agg(F.array_sort(F.collect_list(key)).alias("example_msg_ids"))
    out = best.join(examples, "_cluster").join(texts.select(F.col(key).alias("medoid"), F.col("text").alias("medoid_text")), "medoid", "left")
    out = out.select(F.col("_cluster").getField(group).alias(group), F.col("_cluster.cluster").alias("cluster"), "medoid_text", "size", "example_msg_ids")
    return out.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(F.desc("size"), "cluster")))


def off_script(labelled: DataFrame, messages: DataFrame) -> DataFrame:
    """``msg_id, parent_step, text`` of customers' off-script messages that say something."""
    rows = labelled.filter("not from_me and step_context = 'off_script'").join(messages.select("chat_id", "msg_id", F.col("text").alias("_t")), ["chat_id", "msg_id"])
    return rows.select("msg_id", "parent_step", stripped(F.col("_t")).alias("text")).filter("text <> ''")


def aggregations(labelled: DataFrame, messages: DataFrame, embedder: Callable[[DataFrame, str], DataFrame] = embedded) -> tuple[DataFrame, DataFrame]:
    """What is said at each step, and clusters of what is said off script.

    First ``step_id, on_script_count, off_script_count, top_intents, top_objections`` (arrays of
    ``value, n``); then ``step_id, cluster, medoid_text, size, example_msg_ids, rank``, where the
    step ``unknown`` holds messages before any step. A label without its message counts, at the
    step ``unknown``.
    """
    timed = labelled.join(messages.select("chat_id", "msg_id", "ts_ms"), ["chat_id", "msg_id"])
    parents = with_parent_step(timed).select("chat_id", "msg_id", "parent_step", "ts_ms")
    rows = labelled.join(parents, ["chat_id", "msg_id"], "left").withColumn("parent_step", F.coalesce("parent_step", F.lit(domain.UNKNOWN))).withColumn("_at", F.struct("chat_id", "ts_ms", "msg_id"))
    rows = saved(rows, "aggregation-labels")
    out = step_counts(rows)
    for value, name in (("intent", "top_intents"), ("objection_type", "top_objections")):
        top = top_values(rows.filter("not from_me"), "parent_step", value, "_at")
        lists = top.groupBy("parent_step").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", F.col(value).alias("value"), "n"))), lambda s: F.struct(s["value"].alias("value"), s["n"].alias("n"))).alias(name))
        out = out.join(lists, "parent_step", "left").withColumn(name, F.coalesce(name, F.array().cast("array<struct<value:string,n:bigint>>")))
    texts = saved(off_script(rows, messages), "aggregation-texts")
    vectors = saved(embedder(texts.select("msg_id", "text"), "msg_id"), "aggregation-vectors")
    found = saved(density_clusters(texts.select("msg_id", F.col("parent_step").alias("step_id")).join(vectors, "msg_id"), "step_id", "msg_id", "vector"), "aggregation-clusters")
    steps = out.select(F.col("parent_step").alias("step_id"), "on_script_count", "off_script_count", "top_intents", "top_objections")
    return steps, summaries(found, vectors, texts, "step_id", "msg_id", "vector")


def step_counts(messages: DataFrame) -> DataFrame:
    """On- and off-script customer messages by parent step; steps of neither kind but with an intent or objection stay."""
    rows = messages.filter(~F.col("from_me"))
    out = rows.groupBy("parent_step").agg(
        F.count_if(F.col("step_context") == "on_script").alias("on_script_count"),
        F.count_if(F.col("step_context") == "off_script").alias("off_script_count"),
        F.count_if(F.coalesce("intent", F.lit("")) != "").alias("intents"),
        F.count_if(F.coalesce("objection_type", F.lit("")) != "").alias("objections"),
    )
    return out.filter((F.col("parent_step") != domain.UNKNOWN) & (F.col("on_script_count") + F.col("off_script_count") + F.col("intents") + F.col("objections") > 0))


def nearest_distance(vectors: DataFrame, group: str, key: str, vector: str, block: int = BLOCK) -> DataFrame:
    """Core distance for one neighbour: the least cosine distance to another member of the bucket.

    A bucket is compared block by block, so a large one is many tasks of bounded size.
    """
    kind = dict(vectors.dtypes)
    sizes = vectors.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("_k"))
    dealt = vectors.select(group, key, vector).join(sizes, group).withColumn("_b", F.pmod(F.xxhash64(key), F.col("_k")).cast("int")).withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
    dealt = dealt.select(group, key, vector, "_b", F.least("_b", "_o").alias("_x"), F.greatest("_b", "_o").alias("_y"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.stack([np.asarray(v, dtype=np.float64) for v in pdf[vector]])
        size = np.linalg.norm(x, axis=1)
        u = x / np.where(size == 0, 1, size)[:, None]
        d = 1 - u @ u.T
        np.fill_diagonal(d, np.inf)
        if pdf["_x"].iloc[0] != pdf["_y"].iloc[0]:
            own = pdf["_b"].to_numpy()
            d[own[:, None] == own[None, :]] = np.inf
        return pd.DataFrame({group: pdf[group], key: pdf[key], "core": d.min(axis=1)})

    parts = dealt.groupBy(group, "_x", "_y").applyInPandas(run, f"{group} {kind[group]}, {key} {kind[key]}, core double")
    near = F.min(F.when(F.col("core") < float("inf"), F.col("core")))
    return parts.groupBy(group, key).agg(F.round(near, 6).alias("core"))
