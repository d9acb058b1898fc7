import random
import re

import pytest

from riskspark.llm.decontaminate import find_overlaps

DOCS = "doc_id long, text string, item string, n_words string"
ITEMS = "item_id long, text string, doc_id string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lowered)


def brute(docs, items):
    out = []
    for doc_id, text, *_ in docs:
        w, hit, found = words(text), set(), set()
        for item_id, item_text, *_ in items:
            i = words(item_text)
            if item_id is None or not i:
                continue
            n = min(10, len(i))
            windows = {tuple(i[s : s + n]) for s in range(len(i) - n + 1)}
            for s in range(len(w) - n + 1):
                if tuple(w[s : s + n]) in windows:
                    hit.update(range(s, s + n))
                    found.add(str(item_id))
        out.append((doc_id, len(w), len(hit), sorted(found)))
    return out


def random_case(seed):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "É", "éa", "a1", "zz", "word", "ß"][: rng.choice([2, 4, 8])]
    line = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, line(rng.choice([1, 3, 9, 10, 11, 30])), "x") for i in range(6)]
    items += [(None, line(12), "x"), (7, None, "x"), (8, "--", "x"), items[0], (9, items[1][1], "x")]
    docs = []
    for d in range(30):
        parts = [line(rng.choice([0, 2, 15]))]
        for _ in range(rng.randrange(3)):
            w = words(rng.choice(items)[1])
            at = rng.randrange(len(w) + 1)
            parts += [", ".join(w[at : at + 14]).upper(), line(rng.choice([0, 3]))]
        docs.append((d, "; ".join(parts), "x", "y"))
    return docs + [(None, "The of the", "x", "y"), (31, None, "x", "y"), (32, "", "x", "y"), docs[3], (3, "zz", "x", "y")], items


@pytest.mark.parametrize("seed", range(4))
def test_against_brute_force(spark, seed):
    docs, items = random_case(seed)
    got = find_overlaps(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))
    order = lambda rows: sorted(rows, key=str)
    assert order(map(tuple, got.drop("like").collect())) == order(brute(docs, items))


def test_long_words_in_other_scripts_and_long_texts(spark):
    shared = " ".join(f"w{i}" for i in range(25))
    docs = [(1, "x " * 30_000 + shared + " y" * 30_000, "", ""), (2, "ÀÉ" * 50_000, "", "")]
    got = find_overlaps(spark.createDataFrame(docs, DOCS), spark.createDataFrame([(5, "a " + shared, "")], ITEMS))
    assert sorted(map(tuple, got.drop("like").collect())) == [(1, 60_025, 25, ["5"]), (2, 1, 0, [])]


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    no_items = spark.createDataFrame([], ITEMS)
    assert find_overlaps(none, no_items).count() == 0
    [row] = find_overlaps(spark.createDataFrame([(1, "a b", "", "")], DOCS), no_items).drop("like").collect()
    assert tuple(row) == (1, 2, 0, [])
