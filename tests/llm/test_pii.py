import math
import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskspark.llm.pii import _places, base_spans, find_personal_data, sanitise

SCHEMA = "doc_id long, text string, base string, kind string"

# The patterns as the contract states them.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])

    def luhn(d):
        total = 0
        for i, c in enumerate(reversed(d)):
            v = int(c) * (1 + i % 2)
            total += v - 9 if v > 9 else v
        return total % 10 == 0

    return {
        "email": [m.span() for m in EMAIL.finditer(text)],
        "ip": [m.span() for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))],
        "card": [m.span() for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))],
        "phone": [m.span() for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15],
    }


@pytest.mark.parametrize("alphabet", ["a@.-", "01.", "4 -2", "+1 ().-9", "aé@.b1+ -", "0123456789 -"])
def test_patterns_equal_their_plain_form(alphabet):
    rng = random.Random(alphabet)
    for _ in range(4000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(40)))
        assert base_spans(text) == plain(text), text


def test_long_runs_take_linear_time():
    for text in ["a" * 300_000 + "@", "1" * 300_000, "1." * 150_000, "+" * 300_000, "a@" * 150_000, "1 " * 150_000]:
        base_spans(text)


def corpus():
    rows = [(i, f"filler number words alpha{i} common text here", "x", "y") for i in range(200)]
    for i in (300, 301, 302):
        rows.append((i, f"common nickname zorblax wrote jo.doe@mail.example.org today é{i}", "x", "y"))
    rows += [(400, "zorblax zorblax", "x", "y"), (401, None, "x", "y"), (402, "", "x", "y"), (None, "+49 170 1234567", "x", "y")]
    rows += [rows[200], (500, "card 4111 1111 1111 1111 ip 10.0.0.1 300.1.1.1", "x", "y")]
    return rows


def test_terms_that_tell_the_entity(spark):
    got = find_personal_data(spark.createDataFrame(corpus(), SCHEMA).repartition(3)).collect()
    assert len(got) == len(corpus())
    by_id = {}
    for r in got:
        by_id.setdefault(r["doc_id"], []).append(r)
    texts = {r[0]: r[1] for r in corpus()}
    terms = {texts[300][s["start"] : s["end"]] for s in by_id[300][0]["added"]}
    # zorblax stands in 5 rows, 4 of them with the address; common stands nearly everywhere.
    assert {"nickname", "wrote", "today", "zorblax"} == terms
    kinds = {texts[300][s["start"] : s["end"]]: s["kind"] for s in by_id[300][0]["added"]}
    # Of 4 rows with both one 16th is taken off: wrote leaves 0.1 bits, zorblax 0.4.
    assert kinds["wrote"] == kinds["zorblax"] == "removed"
    stricter = find_personal_data(spark.createDataFrame(corpus(), SCHEMA), remove=0.3).where("doc_id = 300").first()
    kinds = {texts[300][s["start"] : s["end"]]: s["kind"] for s in stricter["added"]}
    assert kinds["wrote"] == "removed" and kinds["zorblax"] == "generalised"
    assert by_id[300][0]["added"] == by_id[300][1]["added"] if len(by_id[300]) > 1 else True
    assert [r["base"] for i in (400, 401, 402) for r in by_id[i]] == [[], [], []]
    assert not by_id[400][0]["added"]  # not near the entity
    assert [s["kind"] for s in by_id[None][0]["base"]] == ["phone"]
    assert [s["kind"] for s in by_id[500][0]["base"]] == ["ip", "card"]


def told_terms(rows, generalise, remove, smooth=True):
    """{(key, text, start): kind} by a plain loop over entities, terms and rows."""
    term = re.compile(r"[^\W\d_]{2,}")
    entities, terms, places = [], [], []
    for _, text, *_ in rows:
        found = plain(text or "")
        spans = [s for own in found.values() for s in own]
        own = set()
        for kind, of_kind in found.items():
            for a, b in of_kind:
                value = text[a:b]
                own.add((kind, value.lower() if kind in ("email", "ip") else re.sub("[^0-9]", "", value)))
        entities.append(own)
        terms.append({m[0].lower() for m in term.finditer(text or "")})
        outside = [m for m in term.finditer(text or "") if all(m.end() <= a or b <= m.start() for a, b in spans)]
        places.append([(m[0].lower(), m.start()) for m in outside])
    n, out = len(rows), {}
    for e in set().union(*entities):
        of = [i for i in range(n) if e in entities[i]]
        bits = math.log2(n / len(of))
        for t in {t for i in of for t, _ in places[i]}:
            both = sum(1 for i in of if any(t == u for u, _ in places[i]))
            all_rows = sum(1 for own in terms if t in own)
            s = 1 - 0.5**both if smooth else 1
            told = math.log2(s * both * n / len(of) / all_rows)
            if bits > 0 and told >= generalise * bits:
                kind = "removed" if bits - told <= remove else "generalised"
                for i in of:
                    for u, start in places[i]:
                        if u == t:
                            at = rows[i][0], rows[i][1], start
                            out[at] = max(kind, out.get(at, ""))
    return out


@pytest.mark.parametrize("seed, generalise, remove", [(1, 0.5, 0.5), (2, 0.8, 0.9), (3, 0.6, 0.45)])
def test_told_terms_against_brute_force(spark, seed, generalise, remove):
    rng = random.Random(seed)
    names = ["ann@x.org", "Bob@y.org", "bob@Y.org", "+1 555 123 4567", "10.0.0.9", "cy@z.net"]
    vocabulary = ["alpha", "Beta", "no", "é", "gamma", "delta", "omega", *(f"rare{'abcdefghij'[k]}" for k in range(10))]
    rows = []
    for i in range(200):
        words = [rng.choice(vocabulary[4:7]) for _ in range(3)]
        if rng.random() < 0.3:
            n = rng.randrange(6)
            words += [vocabulary[n]] * (rng.random() < 0.8) + [names[n]] + rng.sample(vocabulary, 2)
        if i % 40 == 0:  # a list of addresses that stand nowhere else
            words += [f"u{k}@list{i}.org" for k in range(30)] + [f"listed{'abcde'[i // 40]}"]
        rng.shuffle(words)
        rows.append((i, " ; ".join(words), "", ""))
    rows += [rows[0], rows[40], (7, None, "", ""), (None, "ann@x.org raree", "", "")]
    want = told_terms(rows, generalise, remove)
    assert set(want.values()) == {"generalised", "removed"}
    assert want != told_terms(rows, generalise, remove, smooth=False)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = find_personal_data(docs, generalise=generalise, remove=remove)
    like = {r["like"]: r["text"] for r in docs.select(F.xxhash64("text").alias("like"), "text").collect()}
    got = {(r["doc_id"], like[r["like"]], s["start"]): s["kind"] for r in found.collect() for s in r["added"]}
    assert got == want


def test_long_rows_in_parts(spark, monkeypatch):
    monkeypatch.setattr("riskspark.llm.pii.PART", 7)
    batch = pa.RecordBatch.from_arrays(
        [pa.array([1, 2, 3]), pa.array([4, 5, 6]), pa.array(["a@b.org " + "ab cd ef " * 7, "none", "a@b.org"])], names=["id", "like", "text"]
    )
    monkeypatch.setattr("riskspark.llm.pii.TaskContext", type("T", (), {"get": staticmethod(lambda: type("C", (), {"partitionId": lambda self: 2})())}))
    shared = type("B", (), {"value": frozenset({"cd"})})
    (out,) = _places(shared)(iter([batch]))
    rows = out.to_pylist()
    assert [(r["id"], len(r["terms"]), len(r["entities"])) for r in rows] == [(1, 7, 1), (1, 7, 0), (1, 0, 0), (3, 0, 1)]
    assert [f for r in rows[:2] for f in r["firsts"]].count(True) == 2
    assert rows[0]["row"] == rows[1]["row"] != rows[3]["row"]


def test_clashing_names_in_sanitised_rows(spark):
    schema = "doc_id long, _spans string, text string, spans string, row int, `a.b` int, id string, like string"
    docs = spark.createDataFrame([(1, "s", "mail me@x.org now", "t", 1, 2, "i", "l"), (None, None, None, None, None, None, None, None)], schema)
    got = sanitise(docs)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(1, "s", "mail [EMAIL] now", "t", 1, 2, "i", "l"), (None,) * 8], key=str
    )


def test_entity_of_a_single_row(spark):
    """A term only in that row tells it, in any paragraph, at all its places, with two letters too."""
    far = "plain words again\n\n" * 30
    rows = [(i, f"{far} to be filled number {i}", "x", "y") for i in range(1500)]
    rows.append((9000, f"Zorblax Ng wrote {far} jo.doe@mail.example.org {far} said zorblax", "x", "y"))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    added = find_personal_data(docs).where("doc_id = 9000").first()["added"]
    text = rows[-1][1]
    assert [text[s["start"] : s["end"]] for s in added] == ["Zorblax", "Ng", "wrote", "said", "zorblax"]
    assert {s["kind"] for s in added} == {"generalised"}  # one meeting may be chance
    clean = {r["doc_id"]: r["text"] for r in sanitise(docs).collect()}
    assert clean[9000] == f"[TERM] [TERM] [TERM] {far} [EMAIL] {far} [TERM] [TERM]"
    assert all(clean[i] == text for i, text, *_ in rows[:-1])


def test_sanitised_rows(spark):
    docs = spark.createDataFrame(corpus(), SCHEMA)
    out = sanitise(docs)
    assert out.schema == docs.schema and out.count() == docs.count()
    text = {r["doc_id"]: r["text"] for r in out.collect()}
    assert "jo.doe" not in text[300] and "[EMAIL]" in text[300] and "common" in text[300]
    assert text[500] == "card [CARD] ip [IP] 300.1.1.1"
    assert text[401] is None and text[402] == "" and text[0] == corpus()[0][1]


def test_empty(spark):
    assert find_personal_data(spark.createDataFrame([], SCHEMA)).count() == 0
