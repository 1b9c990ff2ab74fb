import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF_SMALL
from odd import TEXTS, no_documents, odd_documents, saved

from tablewright.llm import near_duplicates as nd
from tablewright.llm.common import WordHash
from tablewright.llm.components import components

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def shingle_set(text):
    w = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    k = min(5, len(w))
    return frozenset(" ".join(w[i : i + k]) for i in range(len(w) - k + 1)) if w else frozenset()


def brute(docs):
    """{row number: (class, links, linked texts, class rows)} from all pairs."""
    sets = [shingle_set(t) for _, t in docs]
    links, parent = defaultdict(set), list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b, shared = sets[j], len(a & sets[j])
            if a and b and 5 * shared >= 4 * (len(a) + len(b) - shared):
                links[i].add(j)
                links[j].add(i)
                parent[max(find(i), find(j))] = min(find(i), find(j))
    members = defaultdict(list)
    for i in range(len(docs)):
        members[find(i)].append(docs[i][0])
    out = []
    for i in range(len(docs)):
        held = members[find(i)]
        ids = [x for x in held if x is not None]
        texts = {sets[j] for j in links[i]} - {sets[i]}
        out.append((docs[i][0], min(ids) if ids else None, len(links[i]), len(texts), len(held)))
    return Counter(out)


def found(df):
    rows, sets = nd.classes(df)
    return Counter((r.doc, r.class_id, r.n_links, r.n_linked_texts, r.class_rows) for r in nd.join_rows(rows, sets).collect())


def variants(n, edits, seed=1, words=120):
    """A text and copies of it with a few words changed each."""
    r = random.Random(seed)
    base = [f"w{r.randrange(100_000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        text = list(base)
        for _ in range(r.randint(0, edits)):
            text[r.randrange(words)] = f"x{r.randrange(10**6)}"
        out.append(" ".join(text))
    return out


def test_planted_groups_equal_brute_force(spark):
    r = random.Random(9)
    texts = [*variants(60, 4), *variants(5, 6, 2), *variants(8, 3, 3, 40)]
    texts += [" ".join(f"v{r.randrange(10**6)}" for _ in range(50)) for _ in range(80)]
    texts += ["short one", "short one", "Short, ONE!", "a b c d e", "a b c d e f", "", None, "..."]
    docs = [(i, t) for i, t in enumerate(texts)] + [(500, texts[3])] * 4
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert found(df) == brute(docs)


def test_large_nodes_and_blocks_equal_brute_force(spark, monkeypatch):
    """Pivots, further splits and pairs of blocks, made to happen on a small table."""
    monkeypatch.setattr(nd, "LEAF", 8)
    monkeypatch.setattr(nd, "BLOCK", 16)
    monkeypatch.setattr(nd, "MAX_LEVELS", 2)
    docs = list(enumerate(variants(70, 5) + variants(70, 9, 5) + variants(20, 4, 6)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert found(df) == brute(docs)


def test_small_table_equals_brute_force(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    docs = [tuple(r) for r in df.collect()]
    assert found(df) == brute(docs)
    rows = nd.op2_ngram_jaccard_join(spark, SF_SMALL)
    assert rows.columns == ["doc_id", "class_id", "n_links", "n_linked_texts", "class_rows"] and rows.count() == len(docs)


def test_recall_at_the_threshold():
    """Pairs of sets with Jaccard just above 0.8 meet on a sampled path of three levels."""
    r, met, pairs = np.random.default_rng(2), 0, 300
    roots = nd.mix(np.arange(1, nd.runs_for() + 1, dtype=np.uint64))
    for _ in range(pairs):
        v = nd.mix(r.integers(0, 2**62, 210, dtype=np.uint64))
        a, b = nd.tokens_of(v[:190]), nd.tokens_of(v[20:])  # 170 of 210 shared
        nodes = [(int(x), 0) for x in roots]
        while nodes:
            node, level = nodes.pop()
            if level == nd.LEVELS:
                met += 1
                break
            places = nd.sampled(node)
            common = set(nd.children(node, places, a[places]).tolist()) & set(nd.children(node, places, b[places]).tolist())
            nodes += [(c, level + 1) for c in common]
    assert met >= 0.985 * pairs


@pytest.mark.parametrize("n", [3, 13, 40])
def test_intersections_equal_sets(n):
    r = np.random.default_rng(n)
    sets = [np.unique(r.integers(0, 300, r.integers(1, 200)).astype(np.uint32)) for _ in range(n)]
    whole = np.concatenate([shared for _, shared in nd._intersections(sets, strip=16, columns=32)])
    for i in range(n):
        for j in range(n):
            if i != j:
                assert whole[i, j] == len(set(sets[i].tolist()) & set(sets[j].tolist()))


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 99), (7, 7)] + [(200, 201 + i) for i in range(50)]
    df = spark.createDataFrame(edges, "a long, b long")
    roots = {r.id: r.root for r in components(df).collect()}
    assert all(roots[i] == 0 for i in range(41)) and all(roots[i] == 99 for i in (99, 100, 101))
    assert all(roots[i] == 200 for i in range(200, 251))
    assert components(df.limit(0)).count() == 0


def test_odd_rows_and_keep_one(spark, tmp_path):
    docs = odd_documents(spark)
    assert found(docs) == brute(TEXTS)
    kept = nd.keep_one(docs)
    assert kept.schema == docs.schema
    # one of the six copies of the prose stays, under the smallest id; rows without words all stay
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 3, None, 4, 5, 6, 7, 8, 10, 11, 12, 2])
    none = no_documents(spark)
    assert nd.op2_ngram_jaccard_join(spark, saved(none, tmp_path)).count() == 0 and nd.keep_one(none).count() == 0
    assert len(nd.shingles(TEXTS[11][1].encode(), WordHash())) > 0
