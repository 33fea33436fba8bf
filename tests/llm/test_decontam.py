from __future__ import annotations

from thermoloom.llm.decontam import drop_leaks, leaks

ITEM = "If a train leaves Boston with 60 km per hour and Anna waits 3 hours for the 60 km train, how far does it go?"


def _leaks(spark, docs, items):
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id) for r in leaks(frame, bench).collect()}


DOCS = [
    (1, "Some words first. " + ITEM + " And more of them after it."),
    (2, ITEM.upper().replace(",", " |")),
    (3, "x y z. If a train leaves Paris with 80 miles per hour and Maria waits 5 days for the 80 miles train how far does it go"),
    (4, "If a train leaves Boston with no other word in common than these few at the start of it"),
    (5, None), (6, ""), (7, "Short one!"), (8, "say short one"), (9, " ".join(["filler"] * 20_000) + " " + ITEM), (None, ITEM),
    # every number another one: the same template, but not the same question
    (10, "If a train leaves Rome with 1 mm per hour and Otto waits 2 hours for the 7 days train, how far does it go?"),
    (1, "the other text of a row that shares its id"),
]
ITEMS = [(1, ITEM), (2, "short one"), (3, None), (4, ""), (None, ITEM)]


def test_reparameterised_items(spark):
    found = _leaks(spark, DOCS, ITEMS)
    assert found - {(10, 1)} == {(1, 1), (3, 1), (7, 2), (9, 1)}
    # a filter that is full of other items changes nothing
    others = [(100 + k, " ".join(f"w{k}x{j}" for j in range(30))) for k in range(3000)]
    assert _leaks(spark, DOCS, ITEMS + others) == found


def test_slots_have_to_agree(spark):
    words = "alpha beta {} gamma delta {} epsilon zeta {} eta theta {} iota kappa {} lamda my"
    item = words.format(*[5] * 5)
    docs = [(1, words.format(*[9] * 5)), (2, words.format(1, 2, 3, 4, 6))]
    assert _leaks(spark, docs, [(1, item)]) == {(1, 1)}


def test_every_occurrence_is_judged(spark):
    """Occurrences in one document, and windows of the item elsewhere in it, must
    not spoil each other."""
    other = lambda place, km, name, n: f"If a train leaves {place} with {km} km per hour and {name} waits {n} hours for the {km} km train, how far does it go?"
    torn = ITEM.replace("for the", "for all of the time for the")
    scraps = " ".join(f"a train leaves {p} with {k} mm and {q} waits {k + 7} days for the {k + 3} h train so" for k, (p, q) in enumerate(zip(["Rome", "Paris", "Oslo"] * 9, ["Otto", "Maria", "Hugo"] * 9, strict=True)))
    docs = [
        (1, ITEM + " Again. " + other("Paris", 80, "Maria", 5)), (2, other("Rome", 7, "Otto", 4) + " " + other("Oslo", 90, "Paul", 6) + " " + other("Kiel", 31, "Ida", 9)),
        (3, scraps + " " + ITEM + " " + scraps), (4, other("Rome", 7, "Otto", 4) + " " + torn), (5, other("Rome", 7, "Otto", 4)), (5, ITEM),
    ]
    assert _leaks(spark, docs, [(1, ITEM)]) == {(k, 1) for k in range(1, 6)}
    sums = " ".join(f"then the pupil adds {a} to the sum" for a in (3, 14, 15, 92, 65, 35))
    assert _leaks(spark, [(1, "So " + sums + " at last")], [(1, sums)]) == {(1, 1)}


def test_given_passages_are_found_and_dropped(spark):
    """Brute force: documents that hold the words of an item in a row."""
    import re

    read = lambda name: spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet")
    plain = lambda text: " " + " ".join(re.findall(r"[^\W_]+", text.lower())) + " "
    items = [plain(r.text) for r in read("benchmark").collect()]
    want = {r.doc_id for r in read("documents").collect() if any(i in plain(r.text) for i in items)}
    assert want and {r.doc_id for r in leaks(read("documents"), read("benchmark")).collect()} == want
    left = drop_leaks(read("documents"), read("benchmark"))
    assert left.columns == read("documents").columns
    assert {r.doc_id for r in left.collect()} == {r.doc_id for r in read("documents").collect()} - want


def test_odd_and_no_documents(spark, odd, empty):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert leaks(odd, bench).count() == 0
    assert leaks(empty, bench).count() == 0
    assert leaks(odd, bench.limit(0)).count() == 0
    assert drop_leaks(odd, bench).count() == odd.count()


def test_items_of_numbers_names_and_unspaced_scripts(spark):
    """Copies are found although no window has two plain words, or no space; with other values they are not."""
    sums, places = "Calculate 12 * 35 + 17 * 48 - 93", "Rome 1960, Tokyo 1964, Paris 1924, Oslo 1952, Kiel 1936, Berlin 1936"
    han = "小明有三个苹果，小红给了他五个苹果，请问小明现在一共有多少个苹果？"
    thai = "สมชายมีแอปเปิ้ลสามผลและซื้อเพิ่มอีกห้าผลเขามีแอปเปิ้ลกี่ผล"
    items = [(1, sums), (2, places), (3, han), (4, thai)]
    docs = [
        (1, "So: " + sums + " at once."), (2, "The games of " + places + " were held."), (3, "今天我们来看一道题。" + han + "答案是八个。"), (4, thai), (5, "前" + thai + "后"),
        (11, "Calculate 13 * 36 + 18 * 49 - 94"), (12, "Rome 1961, Tokyo 1965, Paris 1925, Oslo 1953, Kiel 1937, Berlin 1937"),
        (13, "今天我们去公园看花，天气很好，孩子们一共放了多少个风筝，没有人知道。"), (14, "Calculate 12 and 35"),
    ]
    assert _leaks(spark, docs, items) == {(1, 1), (2, 2), (3, 3), (4, 4), (5, 4)}


def test_every_text_is_dropped_for_itself(spark):
    """Rows without an id and rows that share one."""
    docs = spark.createDataFrame([(None, ITEM), (None, "clean"), (7, "so " + ITEM), (7, "clean too"), (8, None), (9, "")], "doc_id long, text string").selectExpr("*", "1 AS row", "2 AS item_id")
    kept = drop_leaks(docs, spark.createDataFrame(ITEMS, "item_id long, text string"))
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted([(None, "clean"), (7, "clean too"), (8, None), (9, "")], key=repr)
