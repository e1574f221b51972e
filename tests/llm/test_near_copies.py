"""Near copies by five-word Jaccard against brute force, and the pipeline's stage."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from roadloom.llm import near_copies, simhash

from .conftest import DOCS, rows_of


def shingles(text):
    words = text.encode("utf-8", "surrogatepass").lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def similarity(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def brute_components(rows):
    """The smallest id of each row's component, and the near pairs with their similarity."""
    sets = {i: shingles(t or "") for i, t in rows}
    ids, root = sorted(sets), {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    pairs = []
    for n, b in enumerate(ids):
        for a in ids[:n]:
            if (s := similarity(sets[a], sets[b])) >= 0.8:
                pairs.append((a, b, s))
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}, pairs


def planted(seed=1):
    """Texts with near copies of similarity 0.7 to 0.98: groups, chains, and a passage that many share."""
    rng = random.Random(seed)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    texts = []
    for n in (40, 100, 300, 1000):
        for _ in range(12):
            base = fresh(n)
            texts.append(base)
            for _ in range(2):
                copy = list(base)
                for at in rng.sample(range(n), max(1, round(n * rng.choice((0.005, 0.01, 0.02, 0.025))))):
                    copy[at] = f"v{rng.randrange(10**6)}"
                texts.append(copy)
    crowd = fresh(200)
    for _ in range(60):
        copy = list(crowd)
        copy[rng.randrange(200)] = f"v{rng.randrange(10**6)}"
        texts.append(copy)
    passage = fresh(80)
    texts += [passage + fresh(30) for _ in range(60)]
    chain = fresh(120)
    for at in range(0, 100, 4):
        chain = [*chain[:at], f"c{at}", *chain[at + 1 :]]
        texts.append(chain)
    rng.shuffle(texts)
    return [(i, " ".join(t), None, None, None) for i, t in enumerate(texts)]


@pytest.mark.parametrize("hot", [16, 3, 1])
def test_near_copies_equal_brute_force(spark, hot):
    rows = planted()
    want, pairs = brute_components([r[:2] for r in rows])
    got = dict(rows_of(near_copies.near_duplicates(spark.createDataFrame(rows, DOCS), hot=hot), "doc_id", "component_id"))
    between = [(a, b) for a, b, s in pairs if s <= 0.95]
    caught = sum(got[a] == got[b] for a, b in between)
    print("recall of pairs of 0.8 to 0.95:", caught, "of", len(between))
    assert len(between) > 100
    assert got == want


def test_the_pipelines_stage_drops_near_copies(spark, sf_dir):
    rows = planted(2)
    stay = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, DOCS), sf_dir)
    want, _ = brute_components([r[:2] for r in rows])
    assert sorted(r.doc_id for r in stay.collect()) == sorted(set(want.values()))


def test_the_pipelines_stage_links_fingerprints(spark, sf_dir, monkeypatch):
    """With no two sets in a band, copies within two bits are dropped, unlike texts of one fingerprint aren't."""
    rng = random.Random(3)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    texts = [" ".join(["a b c d e f g"] * 200 + fresh(60)) for _ in range(2)]
    for _ in range(40):
        base = fresh(1500)
        texts += [" ".join(base), " ".join([*base[:700], "changed", *base[701:]])]
    fps = [simhash.fingerprint(t, near_copies.WIDTH) for t in texts]
    assert [near_copies.sketch(t)[1] for t in texts] == fps
    near = lambda i: bin((fps[i] ^ fps[i + 1]) & (2**64 - 1)).count("1") <= 2
    gone = {i + 1 for i in range(2, len(texts), 2) if near(i)}
    assert near(0) and similarity(*map(shingles, texts[:2])) < 0.8 and 5 < len(gone)
    print("copies of one changed word in 1,500 within two bits:", len(gone), "of 40")
    sketches = near_copies.sketches
    monkeypatch.setattr(near_copies, "sketches", lambda docs: sketches(docs).withColumn("bands", F.array(F.xxhash64("own"))))
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    stay = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, DOCS), sf_dir)
    assert sorted(r.doc_id for r in stay.collect()) == [i for i in range(len(texts)) if i not in gone]


@pytest.mark.parametrize("which", ["docs", "odd", "none"])
def test_one_row_of_each_component_stays(spark, which, request):
    df = request.getfixturevalue(which)
    stay = near_copies.deduplicate(df)
    assert stay.columns == df.columns
    want, _ = brute_components(list(enumerate(t for _, t in rows_of(df, "doc_id", "text"))))
    assert stay.count() == len(set(want.values()))
