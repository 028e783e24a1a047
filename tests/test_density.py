"""Density clusters and spanning trees against plain versions, with buckets of many blocks."""

import collections
import itertools

import numpy as np
import pytest

from chatloom.operators import clusters


def distances(x):
    size = np.linalg.norm(x, axis=1)
    u = x / np.where(size == 0, 1, size)[:, None]
    return np.round(np.maximum(1 - u @ u.T, 0), 9)


def plain_clusters(d, least):
    """By its definition: components at every distance, from the greatest down; excess of mass; -1 for noise."""
    n = len(d)

    def parts(of, below):
        left, out = set(of), []
        while left:
            todo = [left.pop()]
            part = set(todo)
            while todo:
                i = todo.pop()
                near = {j for j in left if d[i, j] < below}
                left -= near
                part |= near
                todo += near
            out.append(frozenset(part))
        return out

    levels = sorted({float(d[i, j]) for i, j in itertools.combinations(range(n), 2)}, reverse=True)

    def grow(members, birth):
        """Stability of a cluster born at ``birth``, and what is chosen in and below it."""
        mass, now = 0.0, members
        for level in levels:
            split = parts(now, level)
            if len(split) == 1:
                continue
            lam = 1 / max(level, 1e-12)
            big = [p for p in split if len(p) >= least]
            if len(big) >= 2:
                mass += (lam - birth) * len(now)
                under = [grow(p, lam) for p in big]
                below = sum(m for m, _ in under)
                return (mass, [members]) if mass >= below and members is not every else (below, [c for _, chosen in under for c in chosen])
            mass += (lam - birth) * (len(now) - sum(map(len, big)))
            if not big:
                break
            now = big[0]
        return mass, [members]

    every = frozenset(range(n))
    chosen = grow(every, 0.0)[1] if n else []
    out = [-1] * n
    for k, c in enumerate(sorted((c for c in chosen if c != every), key=min)):
        for i in c:
            out[i] = k
    return out


def blobs(rng, n, dims=4):
    centres = rng.normal(0, 1, (4, dims))
    x = centres[rng.integers(0, 4, n)] + rng.normal(0, 0.15, (n, dims))
    x[rng.random(n) < 0.15] = rng.normal(0, 1, dims)
    return x


@pytest.mark.parametrize("block", [16, 2048])
def test_clusters_equal_their_definition(spark, block):
    rng = np.random.default_rng(5)
    buckets = {g: blobs(rng, n) for g, n in enumerate((70, 40, 11, 5, 4, 1))}
    buckets[6] = np.repeat(rng.normal(0, 1, (3, 4)), 8, axis=0)  # copies
    buckets[7] = np.zeros((6, 4))
    buckets[None] = blobs(rng, 20)
    rows = [(g, 100 - i, x.tolist()) for g, xs in buckets.items() for i, x in enumerate(xs)] + [(0, 500, None), (9, 1, None)]
    got = collections.defaultdict(dict)
    for r in clusters.density_clusters(spark.createDataFrame(rows, "g int, id long, v array<double>").repartition(3), "g", "id", "v", 5, block).collect():
        got[r.g][r.id] = r.cluster
    for g, xs in buckets.items():
        ids = sorted(100 - i for i in range(len(xs)))
        want = plain_clusters(distances(xs[::-1]), 5)
        assert [got[g][i] for i in ids] == want, g
    assert got[0][500] == got[9][1] == -1 and max(got[0].values()) >= 1 and max(got[6].values()) == 2


def test_trees_of_many_blocks_weigh_least(spark):
    rng = np.random.default_rng(6)
    x = blobs(rng, 300, 8)
    x[50:90] = x[10]
    rows = spark.createDataFrame([(1, i, v.tolist()) for i, v in enumerate(x)], "g int, id long, v array<double>")
    d = distances(x)
    one, other, w = clusters._tree(d)
    tree = clusters.spanning_tree(rows, "g", "id", "v", block=64).collect()
    assert len(tree) == 299 and len({i for r in tree for i in (r.a, r.b)}) == 300
    assert sorted(r.w for r in tree) == pytest.approx(sorted(w.tolist()), abs=1e-9) and all(r.w == d[r.a, r.b] for r in tree)
    met = clusters._blocks(rows, "g", "id", 32).select("_x", "_y").distinct().count()
    assert met >= 36  # tasks of one bucket


def test_boruvka_on_edges(spark):
    rng = np.random.default_rng(7)
    edges = sorted({(int(a), int(b)) for a, b in np.sort(rng.integers(0, 60, (300, 2)), axis=1) if a < b} | {(100, 101)})
    rows = [(a, b, float(rng.integers(0, 9))) for a, b in edges]
    root = {i: i for e in edges for i in e}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    want = 0.0
    for a, b, w in sorted(rows, key=lambda r: (r[2], r[0], r[1])):
        if find(a) != find(b):
            root[find(a)] = find(b)
            want += w
    got = clusters.least_tree(spark.createDataFrame(rows, "a long, b long, w double")).collect()
    assert sum(r.w for r in got) == want and len(got) == len(root) - len({find(i) for i in root})
    assert clusters.least_tree(spark.createDataFrame([], "a long, b long, w double")).count() == 0


PRICE, PLACE = "quanto custa qual valor preço tabela", "onde fica endereço aonde rua qual"


def test_learned_embeddings_bring_paraphrases_together(spark):
    """Words of a topic stand together in the corpus; texts that share no word come near each other."""
    rng = np.random.default_rng(9)
    corpus = [" ".join(rng.choice(topic.split(), 3, replace=False)) + " por favor" * int(rng.integers(0, 2)) for topic in (PRICE, PLACE) for _ in range(300)] + ["", None]
    df = spark.createDataFrame([(t,) for t in corpus], "text string").repartition(3)
    texts = ["quanto custa?", "qual o valor?", "qual preço?", "onde fica?", "qual endereço?", "fica aonde?"]
    asked = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, "", None, "quanto custa?"])], "id long, text string")
    embed = clusters.learned_embedder(df, dims=4)
    got = {r.id: np.array(r.vector) for r in embed(asked, "id").collect()}
    again = {r.id: np.array(r.vector) for r in clusters.learned_embedder(df.repartition(5), dims=4)(asked, "id").collect()}
    assert all(np.abs(got[i] - again[i]).max() < 1e-5 for i in got)
    assert [round(float(np.linalg.norm(got[i])), 5) for i in range(9)] == [1.0] * 6 + [0.0, 0.0, 1.0] and (got[0] == got[8]).all()
    near = [max(range(6), key=lambda j: -9 if j == i else got[i] @ got[j]) for i in range(6)]
    assert all((i < 3) == (j < 3) for i, j in enumerate(near))
    vectors = spark.createDataFrame([(0, i, got[i].tolist()) for i in range(6)], "g int, id long, v array<double>")
    found = {r.id: r.cluster for r in clusters.density_clusters(vectors, "g", "id", "v", 3).collect()}
    assert found[0] == found[1] == found[2] != found[3] == found[4] == found[5] and -1 not in found.values()
    assert clusters.learned_embedder(df.limit(0))(asked, "id").count() == 9


def test_blocks_grow_with_their_group(spark):
    """A row is copied once a block: of 3,000 rows two groups in blocks of 32, that would be 46 copies."""
    rows = spark.range(3000).selectExpr("id % 2 as g", "id")
    dealt = clusters._blocks(rows, "g", "id", 32)
    assert dealt.count() <= 3000 * clusters.FEW_BLOCKS
    pairs = dealt.alias("p").join(dealt.alias("q"), ["g", "_x", "_y"]).filter("p.id < q.id").select("p.id", "q.id").distinct()
    assert pairs.count() == 2 * 1500 * 1499 // 2
