import itertools
import random
import re

from sensorlake.llm import decontaminate as dc
from tests.llm.nasty import document_frame, documents, empty

rng = random.Random(5)
ITEMS = [(i, " ".join(f"{rng.choice(['bench', 'item', 'of'])}{rng.randrange(300)}" for _ in range(n))) for i, n in enumerate([13, 14, 20, 35, 60, 12, 3])]
ITEMS += [(10, "lonelyword"), (11, "Five words, in a row!"), (12, ", . !"), (13, "five WORDS in a row")]
ITEMS += [(7, ITEMS[3][1]), (8, None), (9, ""), (None, ITEMS[2][1])]


def toks(text):
    return [w for w in re.split(r"[\x00-/:-@\[-`{-¿ -⁯　-〃]+", (text or "").lower()) if w]


def plain(text, item):
    t, i = toks(text), toks(item)
    best = 0
    if 0 < len(i) < 13:
        return len(i) if any(t[a:a + len(i)] == i for a in range(len(t))) else 0
    for a in range(len(t) - 12):
        for b in range(len(i) - 12):
            best = max(best, sum(x == y for x, y in zip(t[a:a + 13], i[b:b + 13])))
    return best if best >= 11 else 0


def planted():
    rows = [r for r in documents() if len(r[1] or "") < 5000]
    pad = "some words before and behind "
    for k, (i, text) in enumerate(ITEMS[:5]):
        w = text.split()
        rows.append((3000 + 10 * k, pad + text + " " + pad, "en", "a"))
        rows.append((3001 + 10 * k, pad + text.upper().replace(" ", ",  ") + "! " + pad, "en", "a"))
        two = w[:]
        two[4], two[9] = "other", "another"
        rows.append((3002 + 10 * k, pad * 3 + " ".join(two[:13]), "en", "a"))
        three = w[:13]
        three[2] = three[6] = three[10] = "other"
        rows.append((3003 + 10 * k, pad + " ".join(three), "en", "a"))
        rows.append((3004 + 10 * k, " ".join(w[:12]), "en", "a"))
    for k, (i, text) in enumerate(ITEMS[5:9]):
        w = text.split()
        rows.append((4000 + 10 * k, pad + text.upper() + " " + pad, "en", "a"))
        rows.append((4001 + 10 * k, text, "en", "a"))
        rows.append((4002 + 10 * k, pad + " ".join(w[:-1] + ["other"]), "en", "a"))
        rows.append((4003 + 10 * k, pad + " ".join(w[:-1]), "en", "a"))
        rows.append((4004 + 10 * k, " ".join(w[1:] + w[:1]) + " " + text + " " + text, "en", "a"))
    return rows + [rows[-5], rows[-4]]


def test_matches_brute_force(spark):
    rows = planted()
    docs, bench = document_frame(spark, rows), spark.createDataFrame(ITEMS, "item_id long, text string")
    want = sorted(((d, sorted({i for i, x in ITEMS if i is not None and plain(t, x)}), max(plain(t, x) for i, x in ITEMS if i is not None))
                   for d, t, *_ in rows if any(plain(t, x) for i, x in ITEMS if i is not None)), key=str)
    got = sorted(((r["doc_id"], r["item_ids"], r["most_same"]) for r in dc.contaminated(docs, bench).collect()), key=str)
    assert got == want and len(want) >= 27
    clean = dc.clean_documents(docs, bench)
    assert clean.columns == docs.columns
    lost = [d for d, t, *_ in rows if any(plain(t, x) for _, x in ITEMS)]
    assert sorted(str(r["doc_id"]) for r in clean.collect()) == sorted(str(d) for d, *_ in rows if d not in lost)


def test_masks_find_any_two_differences():
    for lost in itertools.combinations(range(dc.WINDOW), dc.WINDOW - dc.SAME):
        assert any(all(m[o] == "0" or p + o not in lost for o in range(len(m))) for m in dc.MASKS for p in range(dc.WINDOW - len(m) + 1))
    assert all(m.startswith("11") for m in dc.MASKS)


def test_empty_tables_and_plans(spark):
    docs, bench = document_frame(spark), spark.createDataFrame(ITEMS, "item_id long, text string")
    assert dc.contaminated(empty(docs), bench).count() == 0
    assert dc.contaminated(docs, empty(bench)).count() == 0
    assert dc.clean_documents(docs, empty(bench)).count() == docs.count()
    plan = dc.contaminated(docs, bench)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_seeds_with_and_without_the_filter(spark):
    docs, bench = document_frame(spark, planted()), spark.createDataFrame(ITEMS, "item_id long, text string")
    marks = dc.seed_rows(bench, [bench["item_id"]]).select("seed").distinct()
    every = dc.seed_rows(docs, dc.text_key()).join(marks, "seed").select("k1", "place", "seed").distinct()
    some = dc.seed_rows(docs, dc.text_key(), dc.bitmaps(bench)).join(marks, "seed").select("k1", "place", "seed").distinct()
    assert every.exceptAll(some).count() == 0 and every.count() == some.count()


def test_items_without_an_id_clean_all_the_same(spark):
    text = " ".join(f"nameless{i}" for i in range(20))
    docs = document_frame(spark, [(1, "before it " + text + " behind it", "en", "a"), (2, "no such words here at all", "en", "a")])
    bench = spark.createDataFrame([(None, text), (1, ITEMS[0][1]), (None, None)], "item_id long, text string")
    assert [r["doc_id"] for r in dc.clean_documents(docs, bench).collect()] == [2]
    assert dc.contaminated(docs, bench).count() == 0


def test_short_items_without_an_id_clean_too(spark):
    docs = document_frame(spark, [(1, "here stands, a SHORT item; there", "en", "a"), (2, "a short thing, item", "en", "a"), (3, "zebra", "en", "a"), (None, "x zebra y", "en", "a")])
    bench = spark.createDataFrame([(None, "A short item."), (4, "zebra")], "item_id long, text string")
    assert [r["doc_id"] for r in dc.clean_documents(docs, bench).collect()] == [2]
    found = sorted(((r["doc_id"], r["item_ids"], r["n_items"], r["most_same"]) for r in dc.contaminated(docs, bench).collect()), key=str)
    assert found == [(3, [4], 1, 1), (None, [4], 1, 1)]
