import random

import numpy as np
import pytest
import xxhash
from llm_data import TINY, messy, nothing  # noqa: F401

from tierstone.llm import simhash
from tierstone.llm.common import table
from tierstone.llm.components import connected_components


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashed = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashed) > len(hashed))


def slow_components(ids, prints):
    parent = list(range(len(ids)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                parent[root(i)] = root(j)
    least = {}
    for i, ident in enumerate(ids):
        if ident is not None:
            least[root(i)] = min(ident, least.get(root(i), ident))
    return [least.get(root(i)) for i in range(len(ids))]


def check(docs):
    source = docs.collect()
    prints = [slow_fingerprint(r["text"]) for r in source]
    expected = sorted(zip([r["doc_id"] for r in source], prints, slow_components([r["doc_id"] for r in source], prints)), key=repr)
    rows = simhash.near_duplicates(docs).collect()
    assert sorted(((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in rows), key=repr) == expected


def test_test_documents(spark):
    check(table(spark, TINY, "documents"))


def test_messy_rows(messy):
    check(messy)


def test_no_rows(nothing):
    assert simhash.near_duplicates(nothing).count() == 0
    assert simhash.keep_one(nothing).count() == 0


@pytest.mark.parametrize("list_rows", [4096, 40, 3])
def test_links_join_what_pairs_join(spark, list_rows):
    """Crowded lists: clusters around a few centres, at every way of splitting them."""
    rng = random.Random(5)
    centres = [rng.getrandbits(64) for _ in range(4)]
    prints = {rng.getrandbits(64) for _ in range(200)} | {0}
    for centre in centres:
        for _ in range(60):
            prints.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))))
    # A crowd that agrees on all but its last two bytes.
    prints |= {centres[0] >> 16 << 16 | rng.getrandbits(16) for _ in range(120)}
    prints = sorted(prints)
    df = spark.createDataFrame([(simhash._signed(p),) for p in prints], "fp long")
    links = simhash.near_links(df, list_rows)
    found = {r["src"]: r["dst"] for r in links.collect()}
    assert all(((a ^ b) % 2**64).bit_count() <= 3 for a, b in found.items())
    nodes = {r["node"]: r["component"] for r in connected_components(links).collect()}
    signed = [simhash._signed(p) for p in prints]
    groups = lambda labels: sorted(sorted(s for s, m in zip(signed, labels) if m == x) for x in set(labels))
    assert groups([nodes.get(s, s) for s in signed]) == groups(slow_components(signed, prints))


def test_one_of_each_group_stays(messy):
    kept = simhash.keep_one(messy)
    assert kept.columns == messy.columns
    groups = {r["component_id"] for r in simhash.near_duplicates(messy).collect()}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(groups)


def test_components_of_a_path_a_star_and_loops(spark):
    path = [(i, i + 1) for i in range(100)]
    star = [(500, 500 + i) for i in range(1, 50)] + [(520, 500)] * 3
    df = spark.createDataFrame(path + star + [(900, 900)], "src long, dst long")
    found = {r["node"]: r["component"] for r in connected_components(df).collect()}
    assert {found[i] for i in range(101)} == {0} and {found[500 + i] for i in range(50)} == {500}
    assert 900 not in found
    assert connected_components(df.where("src < 0")).count() == 0


def test_majority_of_long_texts():
    text = " ".join(str(i % 977) for i in range(70_000))
    assert simhash.fingerprint(text.encode()) == slow_fingerprint(text)
    assert simhash.fingerprint(b"A  B\tC") == simhash.fingerprint(b"a b c")
    assert np.uint64(simhash.fingerprint(b"")) == 0
