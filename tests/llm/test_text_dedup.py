"""ProbMinHash near-duplicates and decontamination against plain Python."""

import random
from collections import Counter

import numpy as np

from tabwright.llm import decontamination, minhash_dedup
from tabwright.llm.minhash_dedup import REGISTERS, prob_min_hash, probability_jaccard, weighted

DOCS = "doc_id long, text string, lang string, source string, digest string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None, None, "clash") for i, t in rows], DOCS).repartition(3)


def plain_jp(a, b):
    x, y = Counter(a), Counter(b)
    sx, sy = sum(x.values()), sum(y.values())
    total = 0.0
    for d in x.keys() & y.keys():
        total += 1 / sum(max((x[e] / sx) / (x[d] / sx), (y[e] / sy) / (y[d] / sy)) for e in x.keys() | y.keys())
    return total


def test_probability_jaccard_and_its_estimate():
    draw = random.Random(2)
    for _ in range(20):
        a = [draw.randrange(30) for _ in range(draw.randrange(1, 80))]
        b = [draw.randrange(5, 40) for _ in range(draw.randrange(1, 80))]
        arrays = [np.unique(np.array(s, np.uint64), return_counts=True) for s in (a, b)]
        assert abs(probability_jaccard(*[(n, c.astype(float)) for n, c in arrays]) - plain_jp(a, b)) < 1e-9
    gaps = []
    for _ in range(40):
        a = [draw.randrange(10**9) for _ in range(60)] * 2 + [draw.randrange(10**9) for _ in range(40)]
        b = a[: draw.randrange(60, 160)] + [draw.randrange(10**9) for _ in range(20)]
        own = np.array([0] * len(a) + [1] * len(b))
        names, counts, owner = weighted(np.array(a + b, np.uint64), own)
        registers = prob_min_hash(names, counts, owner, 2)
        gaps.append((registers[0] == registers[1]).mean() - plain_jp(a, b))
    assert abs(np.mean(gaps)) < 0.03 and np.max(np.abs(gaps)) < 5 * (0.25 / REGISTERS) ** 0.5


def corpus():
    draw = random.Random(6)
    words = ["t%d" % i for i in range(3000)]
    rows = []
    for _ in range(60):
        base = draw.choices(words, k=draw.randrange(30, 300))
        rows.append((len(rows), " ".join(base)))
        for _ in range(draw.randrange(0, 5)):
            copy = list(base)
            for _ in range(draw.randrange(0, 3)):
                copy[draw.randrange(len(copy))] = draw.choice(words)
            rows.append((len(rows), " ".join(copy)))
    hub = draw.choices(words, k=200)  # each copy is near the hub, two copies aren't near each other
    rows.append((9000, " ".join(hub)))
    for k in range(40):
        copy = list(hub)
        for j in range(4):
            copy[(k * 5 + j * 50) % 200] = "x%d_%d" % (k, j)
        rows.append((8000 + k, " ".join(copy)))
    rows += [(7000 + i, "same text here and there") for i in range(30)] + [(7100, "two words"), (7101, "two words"), (7102, "two other")]
    rows += [(7200, None), (7201, ""), (7202, " \n "), (None, "no id at all"), (7300, "long " * 60_000), (7300, "long " * 60_000)]
    return rows


def brute_classes(rows, threshold=0.8):
    def shingles(t):
        w = (t or "").split()
        return [tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))] if w else []

    sets = [shingles(t) for _, t in rows]
    bags = [frozenset(s) for s in sets]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            if (not bags[i] and not bags[j]) or (bags[i] & bags[j] and plain_jp(sets[i], sets[j]) >= threshold):
                root[find(i)] = find(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return Counter((rows[k][0], least.get(find(k))) for k in range(len(rows)))


def test_classes_equal_all_pairs(spark):
    rows = corpus()
    got = minhash_dedup.near_duplicates(frame(spark, rows), block=8).collect()
    assert Counter((r.doc_id, r.class_id) for r in got) == brute_classes(rows)
    assert sum(r.kept for r in got if r.doc_id in range(7000, 7030)) == 1


def pairs_in_boilerplate():
    """150 pairs in one dense group: 0.82 within a pair, 0.79 between any others."""
    plate = ["b%d" % i for i in range(200)]
    rows = []
    for k in range(150):
        for side in (0, 1):
            tail = ["p%d_%d" % (k, i) for i in range(4)] + ["s%d_%d_%d" % (k, side, i) for i in range(22)]
            rows.append((2 * k + side, " ".join(plate + tail)))
    return rows


def test_a_near_copy_among_many_that_are_almost_as_near(spark):
    rows = pairs_in_boilerplate()
    got = minhash_dedup.near_duplicates(frame(spark, rows)).collect()
    assert Counter((r.doc_id, r.class_id) for r in got) == Counter((i, i - i % 2) for i, _ in rows)


def test_links_do_not_depend_on_the_width_of_blocks(spark):
    rows = pairs_in_boilerplate()[:120]
    got = minhash_dedup.near_duplicates(frame(spark, rows), block=8).collect()
    assert Counter((r.doc_id, r.class_id) for r in got) == Counter((i, i - i % 2) for i, _ in rows)


def test_rows_of_a_groups_main_part_do_not_meet(spark):
    from pyspark.sql import functions as F

    from tabwright.llm.grouped import across_parts

    rows = [("g", "m", i) for i in range(200)] + [("g", "o%d" % (i % 3), 1000 + i) for i in range(20)] + [("h", "m", i) for i in range(50)]
    dealt = across_parts(spark.createDataFrame(rows, "k string, part string, id int"), ["k"], "part", F.col("id"), 16).collect()
    assert {r.k for r in dealt} == {"g"} and len(dealt) < 200 * 3 + 20 * 20
    met, blocks = set(), {}
    for r in dealt:
        blocks.setdefault((r.left, r.right), []).append(r)
    for (left, right), held in blocks.items():
        assert len(held) < 80
        for x in held:
            for y in held:
                if x.id < y.id and x.part != y.part and (left == right or x.own_block != y.own_block):
                    met.add((x.id, y.id))
    ids = {i: p for k, p, i in rows if k == "g"}
    assert met == {(x, y) for x in ids for y in ids if x < y and ids[x] != ids[y]}


def test_dedup_empty(spark):
    assert minhash_dedup.near_duplicates(frame(spark, [])).collect() == []


ITEMS = [
    (1, "A train leaves Paris at 12 with 340 people and reaches the old harbour of Lyon after 12 stops, how many people stay in Paris?"),
    (2, "how warm is the water that the fishermen pour over the black stones before dawn"),
    (3, "only four words here"),
    (4, None),
    (5, ""),
    (6, "Sum 3 kg and 4 kg of sand, then take 3 kg away and say what is left in the bag at the end"),
]


def test_leaks(spark):
    fill = " ".join("filler%d" % i for i in range(50))
    docs = [
        (1, f"{fill} {ITEMS[0][1]} {fill}"),  # verbatim
        (2, f"{fill} A train leaves Berlin at 7 with 99 people and reaches the old harbour of Ulm after 7 stops, how many people stay in Berlin? {fill}"),  # another instance
        (3, "A train leaves Berlin at 7 with 99 people and reaches the old harbour of Ulm after 8 stops, how many people stay in Rome?"),  # slots clash
        (4, f"{fill} how warm is the water that the fishermen {fill}"),  # 8 of 15 words: too little
        (5, f"{fill} HOW warm is the water, that the fishermen pour over the black stones. {fill}"),  # 13 words in a row
        (6, fill),
        (7, None),
        (8, ""),
        (9, f"x {ITEMS[2][1]} y"),
        (10, "only four words"),
        (11, "sum 5 kg and 6 kg of sand, then take 5 kg away and say what is left in the bag at the end " + "long " * 50_000),
        (2, f"{ITEMS[1][1]}\n{ITEMS[1][1]}"),
        (None, ITEMS[1][1]),
    ]
    bench = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, doc_id string")
    got = decontamination.find_leaks(frame(spark, docs), bench).collect()
    found = sorted(((r.doc_id, r.item_id, r.kind) for r in got), key=repr)
    want = [(1, 1, "verbatim"), (2, 1, "reparameterised"), (2, 2, "verbatim"), (5, 2, "verbatim"), (9, 3, "verbatim"), (11, 6, "reparameterised"), (None, 2, "verbatim")]
    assert found == sorted(want, key=repr)
    place = next(r for r in got if (r.doc_id, r.item_id) == (1, 1))
    assert (place.start_word, place.end_word) == (50, 50 + len(ITEMS[0][1].split()))
    sliced = decontamination.find_leaks(frame(spark, docs), bench, slice_windows=20).collect()
    assert Counter(sliced) == Counter(got)


def leaks_of(item, text):
    index = decontamination.Index([(1, item)])
    return [(r[3], r[6]) for r in decontamination._leaks(index, 0.8, 13)([7], [text], decontamination.WordTable(decontamination.describe))]


def test_a_slot_that_clashes_takes_out_its_own_windows_alone():
    words = ["w%d" % i for i in range(40)]
    words[5] = words[30] = "12"
    changed = list(words)
    changed[30] = "15"
    assert leaks_of(" ".join(words), " ".join(changed)) == [("verbatim", 30)]
    # A run of other values, and a clash elsewhere on its diagonal.
    far = ["z%d" % i for i in range(40)]
    far[:16], far[28:33] = words[:16], words[28:33]
    far[5], far[30] = "7", "9"
    assert leaks_of(" ".join(words), " ".join(far)) == [("reparameterised", 16)]
    # Without a meaning that holds in most slots, short of coverage and run: no leak.
    near = "read 12 words to the 12 men"
    assert leaks_of(near, "read 7 words to the 8 men") == []


def test_names_that_begin_sentences_and_values_of_other_lengths():
    item = "Tom buys red apples at the old market near home.\nTom then eats some of them by the quiet river.\nTom now asks how many are left in his bag."
    assert leaks_of(item, item.replace("Tom", "Anna"))[0][0] == "reparameterised"
    assert leaks_of(item, item.replace("Tom", "Anna Maria"))[0][0] == "reparameterised"
    assert leaks_of(item, item) and leaks_of(item, item)[0][0] == "verbatim"
    item = "a man walks 5 km from New York to a place and needs twenty five minutes, how fast"
    assert leaks_of(item, "x " + item.replace("New York", "Paris").replace("twenty five", "30").replace("5 km", "5km"))[0][0] == "reparameterised"


def test_names_in_capitals_and_words_put_in_or_left_out():
    item = "on a warm day Natalia sold 48 red clips to her old friends at the market and then Natalia asked how many clips were left"
    assert leaks_of(item, item.replace("Natalia", "MARIA").replace("48", "51"))[0][0] == "reparameterised"
    assert leaks_of(item.replace("Natalia", "NATALIA"), item.replace("Natalia", "Maria"))[0][0] == "reparameterised"
    assert leaks_of(item, item.replace("red", "RED"))[0][0] == "verbatim"
    short = "how warm is the water that the fishermen pour over the stones"
    assert leaks_of(short, "so " + short.replace("that the", "that all the"))[0][0] == "verbatim"
    assert leaks_of(short, "so " + short.replace("that the", "the"))[0][0] == "verbatim"
    assert leaks_of(short, "how warm is the water in the sea, and that the fishermen pour over the stones") == []


def test_two_names_do_not_become_one_but_two_numbers_may():
    item = "the road from Paris to the old town of Rome is long"
    assert leaks_of(item, item.replace("Paris", "Ulm").replace("Rome", "Bern"))[0][0] == "reparameterised"
    assert leaks_of(item, item.replace("Paris", "Ulm").replace("Rome", "Ulm")) == []
    item = "the road from 12 to the old town of 7 is long"
    assert leaks_of(item, item.replace("12", "5").replace("7", "5"))[0][0] == "reparameterised"


def test_repeated_documents_and_items(spark):
    bench = spark.createDataFrame([(2, ITEMS[1][1]), (2, ITEMS[1][1])], "item_id long, text string")
    got = decontamination.find_leaks(frame(spark, [(5, ITEMS[1][1]), (5, ITEMS[1][1])]), bench).collect()
    assert [(r.doc_id, r.item_id, r.kind) for r in got] == [(5, 2, "verbatim")] * 4


def test_against_a_plain_template_matcher(spark):
    """Items as lists of fixed words and slots, documents with instances of them: every instance and nothing else is found."""
    draw = random.Random(9)
    names, fixed = ["Anna", "Bert", "Cleo", "Dora", "Emil", "Frida"], ["w%d" % "abcdefghij".index(c) + c * 2 for c in "abcdefghij"]
    items, docs, want = [], [], set()

    def spell(slots, values):
        return " ".join(values.get(w, w) for w in slots)

    for k in range(12):
        slots = [draw.choice(fixed) + "%s" % chr(97 + k) for _ in range(24)]
        for at, mark in ((3, "#n"), (9, "#1"), (14, "#m"), (20, "#n")):
            slots[at] = mark
        items.append((k, slots, {"#n": names[0], "#m": names[1], "#1": str(10 + k)}))
    for d in range(80):
        slots = draw.choice(items)
        values = {"#n": draw.choice(names[2:4]), "#m": draw.choice(names[4:]), "#1": str(draw.randrange(100, 999))}
        fill = " ".join("fill%d" % draw.randrange(1000) for _ in range(30))
        body = spell(slots[1], values)
        if d % 4 == 3:
            words = body.split()
            draw.shuffle(words)
            body = " ".join(words)
        else:
            want.add((d, slots[0]))
        docs.append((d, f"{fill} {body} {fill}"))
    bench = spark.createDataFrame([(k, spell(s, v)) for k, s, v in items], "item_id long, text string")
    got = decontamination.find_leaks(frame(spark, docs), bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and all(r.kind == "reparameterised" for r in got)


def test_a_run_counts_words_of_folded_values():
    words = ["w%d" % i for i in range(60)]
    words[3:5], words[8:10] = ["New", "York"], ["twenty", "five"]
    far = words[:14] + ["z%d" % i for i in range(40)]
    assert leaks_of(" ".join(words), " ".join(far)) == [("verbatim", 14)]


def test_leaks_empty(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.find_leaks(frame(spark, [(1, "a b c d e f")]), none).collect() == []
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontamination.find_leaks(frame(spark, []), bench).collect() == []
