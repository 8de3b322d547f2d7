import hashlib
import random
import re

from tablestream.llm import fim
from tablestream.llm.common import CACHE_ENTRIES

UNIT = re.compile("[A-Za-z]+|[^A-Za-z]")


def by_units(text, row_id, rate=90):
    """The transformation unit by unit."""
    units = UNIT.findall(text)
    n, h = len(units), hashlib.sha256(f"1:{'' if row_id is None else row_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_random_texts_equal_the_unit_by_unit_form():
    r, chunks = random.Random(5), fim.Chunks()
    for k in range(1500):
        text = "".join(r.choices("abZ .é中\n<P>S", k=r.randint(0, 900)))
        if k % 3 == 0:
            text = r.choice(("a", ".", "<", "aé")) * r.randint(1, 12_000) + text
        got = fim.transform_text(text, k, chunks)
        assert got == by_units(text, k)
        assert fim.restore_text(got[4], got[1]) == text


def test_every_cut_of_a_text_is_found():
    r = random.Random(6)
    text = "".join(r.choice(("word", " ", "中", "x" * 700, ".")) for _ in range(400))
    index, ends = fim.UnitIndex(text, fim.Chunks()), [0]
    for unit in UNIT.findall(text):
        ends.append(ends[-1] + len(unit))
    assert index.n == len(ends) - 1 and len(index.ends) > 15
    assert [index.place(k) for k in range(index.n + 1)] == ends


def test_shared_passages_share_chunks():
    r = random.Random(7)
    passage = "".join(r.choices("abcdefgh ", k=20_000))
    chunks = fim.Chunks()
    fim.UnitIndex("first " + passage, chunks)
    before = len(chunks)
    fim.UnitIndex("another, longer beginning: " + passage, chunks)
    assert before > 40 and len(chunks) - before <= 2
    assert max(map(len, chunks)) <= fim.LONGEST and before < CACHE_ENTRIES


def test_chunk_ends_do_not_depend_on_hash_blocks(monkeypatch):
    text = "".join(random.Random(8).choices("abc d\n", k=5000))
    want = fim.chunk_ends(text)
    monkeypatch.setattr(fim, "HASH_BLOCK", 97)
    assert fim.chunk_ends(text) == want


def test_a_sentinel_that_only_the_output_forms_is_no_obstacle():
    for k in range(300):
        for text in ("<P", "a<S", "P>a", "<<S", ">x<M", "<S <P <M"):
            n, form, _, _, out = fim.transform_text(text, k, fim.Chunks())
            assert fim.restore_text(out, form) == text


def test_odd_rows(spark):
    rows = [(1, "", "x"), (2, None, "x"), (None, "some text of words", "x"), (None, "some text of words", "x"),
            (3, "has <M> inside", "x"), (4, "Z" * 3_000_000 + " é " + "w " * 400_000, "x")]
    df = spark.createDataFrame(rows, "doc_id int, text string, n string")
    got = [tuple(r) for r in fim.transform(df).collect()]
    want = []
    for i, t, _ in rows:
        n, form, p, m, out = by_units(t or "", i)
        want.append((i, n, form, p, m, hashlib.sha256(out.encode()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest(), out))
    assert sorted(got, key=str) == sorted(want, key=str)
    assert {g[2] for g in got if g[0] in (1, 2, 3)} == {"plain"}
    assert fim.transform(df.limit(0)).count() == 0


def test_rates(spark):
    df = spark.createDataFrame([(i, "one two three") for i in range(2000)], "doc_id long, text string")
    assert fim.transform(df, rate=0).filter("form <> 'plain'").count() == 0
    forms = {r["form"]: r["count"] for r in fim.transform(df).groupBy("form").count().collect()}
    assert 1700 < forms["psm"] + forms["spm"] < 1900 and 280 < forms["spm"] < 440
