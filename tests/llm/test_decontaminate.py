import random
import re
import unicodedata

from cases import empty, long_text, odd, plain

from larkspur.llm import decontaminate, queries


def brute_distance(item, words):
    """Edit distance of the item to the closest run of words."""
    now = [0] * (len(words) + 1)
    for i, x in enumerate(item):
        nxt = [i + 1]
        for j, y in enumerate(words):
            nxt.append(min(now[j] + (x != y), now[j + 1] + 1, nxt[j] + 1))
        now = nxt
    return min(now)


def words(text):
    """Letters, digits and marks between other signs; one by one where a script has no blanks."""
    out = [""]
    for c in text.lower():
        kind = unicodedata.category(c)
        if kind == "Cf":
            continue
        if not (c.isalnum() or kind[0] == "M"):
            out.append("")
        elif re.match("(CJK|HIRAGANA|KATAKANA|THAI|LAO|KHMER|MYANMAR)", unicodedata.name(c, "")):
            out += [c, ""]
        else:
            out[-1] += c
    return [w for w in out if w]


def edited(rng, item, edits):
    out = list(item)
    for _ in range(edits):
        at, kind = rng.randrange(len(out)), rng.randrange(3)
        if kind == 0:
            out[at] = f"new{rng.randrange(999)}"
        elif kind == 1:
            del out[at]
        else:
            out.insert(at, f"more{rng.randrange(999)}")
    return out


def test_query_finds_the_leaks_of_the_tables(spark, small_dir):
    items = {r.item_id: words(r.text) for r in spark.read.parquet(f"{small_dir}/benchmark.parquet").collect()}
    docs = [(r.doc_id, words(r.text)) for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect() if len(r.text) < 4000]
    found = {(r.doc_id, r.item_id): r.distance for r in queries.QUERIES["op7_benchmark_decontamination"](spark, small_dir).collect()}
    for d, text in docs[:250] + [x for x in docs if any(k[0] == x[0] for k in found)]:
        for i, item in items.items():
            if len(set(item) & set(text)) < 0.5 * len(set(item)):
                continue
            best = brute_distance(item, text)
            if best <= int(0.2 * len(item)):
                assert found[d, i] == best
            else:
                assert (d, i) not in found


def test_recall_at_the_distance_limit(spark):
    """Runs at most 20 % of edits away from an item, inside other words: at least 95 of 100 are found, none falsely."""
    rng = random.Random(11)
    vocabulary = [f"v{i}" for i in range(3000)]
    items = [rng.choices(vocabulary, k=rng.randrange(15, 60)) for _ in range(60)]
    texts, wanted = [], set()
    for d in range(400):
        around = rng.choices(vocabulary[:1500] + [f"o{i}" for i in range(3000)], k=150)
        i = rng.randrange(len(items))
        run = edited(rng, items[i], rng.randrange(0, int(0.2 * len(items[i])) + 1))
        texts.append((d, " ".join(around[:70] + run + around[70:])))
        wanted.add((d, i))
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    rows = decontaminate.contaminations(docs, bench).collect()
    found = {(r.doc_id, r.item_id) for r in rows}
    assert found <= wanted and len(found) >= 0.95 * len(wanted)
    by = dict(texts)
    for r in rows[:100]:
        run = words(by[r.doc_id])[r.first_word : r.last_word]
        assert brute_distance(items[r.item_id], words(by[r.doc_id])) == r.distance
        assert brute_distance(items[r.item_id], run) == r.distance
    clean = {r.doc_id for r in decontaminate.clean(docs, bench).collect()}
    assert clean == {d for d, _ in texts} - {d for d, _ in found}


def edited_at(rng, item, places):
    out = list(item)
    for at in sorted(places, reverse=True):
        kind = rng.randrange(3)
        if kind == 0:
            out[at] = f"new{rng.randrange(999)}"
        elif kind == 1:
            del out[at]
        else:
            out.insert(at, f"more{rng.randrange(999)}")
    return out


def test_recall_at_exactly_the_limit_wherever_the_edits_are():
    """Exactly 20 % edits at the head, in the first half, at the tail and spread: 99 of 100 are found for each."""
    rng = random.Random(3)
    vocabulary = [f"v{i}" for i in range(3000)]
    layouts = {
        "head": lambda n, k: range(k),
        "first half": lambda n, k: rng.sample(range(n // 2), k),
        "tail": lambda n, k: range(n - k, n),
        "spread": lambda n, k: rng.sample(range(n), k),
    }
    found = dict.fromkeys(layouts, 0)
    for length in (10, 15, 30, 50, 100):
        items = [rng.choices(vocabulary, k=length) for _ in range(200)]
        index = decontaminate.Index([" ".join(x).encode() for x in items])
        for layout, places in layouts.items():
            texts = []
            for item in items:
                around = rng.choices(vocabulary[:1500] + [f"o{i}" for i in range(3000)], k=100)
                run = edited_at(rng, item, places(length, length // 5))
                texts.append(" ".join(around[:50] + run + around[50:]).encode())
            found[layout] += sum(i in hits for i, hits in enumerate(index.search(texts)))
    assert min(found.values()) >= 0.99 * 1000, found


def test_case_punctuation_and_long_texts(spark):
    item = "Which of these nine planets is closest to the bright yellow sun?"
    texts = [(1, "x " + item.upper().replace(" ", ",  ") + " y"), (2, long_text() + " " + item), (3, item[:30])]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    bench = spark.createDataFrame([(1, item), (1, item), (None, "six words that nobody has here"), (2, ""), (3, None)], "item_id long, text string")
    assert {(r.doc_id, r.item_id, r.distance) for r in decontaminate.contaminations(docs, bench).collect()} == {(1, 1, 0), (2, 1, 0)}


def test_words_of_any_script():
    rng = random.Random(1)
    signs = "ab é ß ж ä — “x” «y» \u00a0 \u2009 \u200d … 、。日本ひらカタ ไทย ü¿¡ a_b 1² ﬁ e\u0301 한국 .,- ж\u00a0я".split(" ") + ["\u00a0", "\u3000", " ", "\n"]
    for _ in range(2000):
        text = "".join(rng.choices(signs, k=rng.randrange(12)))
        assert [w.decode() for w in decontaminate.split_words(text.lower().encode())] == words(text), text


ITEM = "Which of these nine planets is closest to the bright yellow sun of the inner system today"
CHINESE = "光年是长度单位不是时间单位它表示光在真空中一年内走过的距离大约等于九万四千六百亿公里"


def test_other_blanks_signs_and_scripts(spark):
    """Exact copies with no-break spaces, dashes and quotes between words; an item in a script without blanks inside a text."""
    texts = [
        (1, "x " + ITEM.replace(" ", "\u00a0") + " y"),
        (2, "say “" + ITEM.replace(" ", " — ") + "”…"),
        (3, "我们都知道，" + CHINESE + "。这是一个很长的故事"),
        (4, "我们都知道这是一个很长的故事没有别的意思" * 3),
        (5, "\u200b".join(ITEM)),
    ]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    bench = spark.createDataFrame([("a", ITEM), ("b", CHINESE)], "item_id string, text string")
    found = {(r.doc_id, r.item_id, r.distance) for r in decontaminate.contaminations(docs, bench).collect()}
    assert found == {(1, "a", 0), (2, "a", 0), (3, "b", 0), (5, "a", 0)}
    assert {r.doc_id for r in decontaminate.clean(docs, bench).collect()} == {4}


def test_recall_at_the_limit_without_blanks():
    rng, hits = random.Random(8), 0
    items = ["".join(rng.choices([chr(0x4E00 + i) for i in range(2500)], k=rng.randrange(15, 60))) for _ in range(200)]
    index = decontaminate.Index([x.encode() for x in items])
    texts = []
    for item in items:
        out = list(item)
        for at in rng.sample(range(len(out)), len(out) // 5):
            out[at] = chr(0x4E00 + rng.randrange(2500))
        around = "".join(chr(0x4E00 + rng.randrange(2500)) for _ in range(80))
        texts.append((around[:40] + "".join(out) + around[40:]).encode())
    hits = sum(i in found for i, found in enumerate(index.search(texts)))
    assert hits >= 0.99 * len(items)


def test_ids_of_other_types(spark):
    docs = spark.createDataFrame([(1, ITEM)], "doc_id long, text string")
    for kind in ("short", "double", "decimal(10,2)", "date"):
        bench = spark.createDataFrame([(ITEM,)], "text string").selectExpr(f"CAST({'current_date()' if kind == 'date' else 7} AS {kind}) item_id", "text")
        (row,) = decontaminate.contaminations(docs, bench).collect()
        assert row.item_id == bench.first().item_id


def test_odd_rows_and_empty_tables(spark):
    df = odd(spark)
    bench = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog")], "item_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.doc_id for r in decontaminate.contaminations(df, bench).collect()] == [1]
    kept = decontaminate.clean(df, bench)
    assert kept.columns == df.columns and plain(kept.select("doc_id", "text")) == plain(df.select("doc_id", "text").where("doc_id <> 1 or doc_id is null"))
    assert decontaminate.contaminations(df, none).collect() == [] and decontaminate.clean(df, none).count() == df.count()
    assert decontaminate.contaminations(empty(spark), bench).collect() == []


def test_blocks_of_items_give_the_same(spark, small_dir, monkeypatch):
    docs, bench = (spark.read.parquet(f"{small_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    want = plain(decontaminate.contaminations(docs, bench))
    monkeypatch.setattr(decontaminate._blocks, "__defaults__", (4000,))
    assert plain(decontaminate.contaminations(docs, bench)) == want
