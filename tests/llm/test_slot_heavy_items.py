"""Items of many slots and items that open with a name are found."""

from pyspark.sql import functions as F

from listforge.llm import decontaminate

ITEMS = [
    (1, "A train drives 60 km in 2 hours, then 90 km in 3 hours."),
    (2, "Add 12 and 7 and 9 and 4"),
    (3, "Alice Bob Carol Dave Erin Frank Grace Heidi Ivan"),
    (4, "Alice has 5 apples and gives two of them to her brother"),
    (5, "The boat is late. Alice waits for 5 more hours at the pier"),
    (6, "12 7 9 4 33"),
    (7, "Paris. Rome. Oslo. Bern. Cairo. Lima. Quito. Delhi. Tokyo. Seoul."),
]


def found(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    return {(r.doc_id, r.item_id) for r in decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()}


def test_verbatim_copies_are_found(spark):
    docs = [(k, f"some words in front {t} and some behind") for k, t in ITEMS] + [(10 + k, f"Question: {t}\nAnswer") for k, t in ITEMS]
    assert found(spark, docs) == {(k, k) for k, _ in ITEMS} | {(10 + k, k) for k, _ in ITEMS}


def test_other_names_and_values(spark):
    docs = [
        (1, "Bob has 7 apples and gives two of them to her brother"),
        (2, "we know that Bob has 7 apples and gives two of them to her brother"),
        (3, "while the boat is late. Carol waits for 6 more hours at the pier"),
        (4, "A train drives 61 km in 2 hours, then 95 km in 4 hours."), (8, "A train drives 61 km in 2 hours, then 61 km in 4 hours."),  # one value for two
        (5, "Add 1 and 2 and 3 and 5"), (6, "13 7 9 4 33"), (7, "Mary John Rob Sue Tim Tom Ann Joe Kim"),
    ]
    assert found(spark, docs) == {(1, 4), (2, 4), (3, 5), (4, 1)}


#: Everyday questions with their slots: {a} to {d} numbers, {P} and {Q} names, {u} a unit.
QUESTIONS = [
    "Compute {a} + {b} * {c} and then subtract {a} from the result.", "What is {a} times {b} plus {c}?", "{P} has {a} apples. {P} buys {b} more and gives {c} to {Q}. How many apples does {P} have?",
    "A car drives {a} {u} in {b} hours. How far does it drive in {c} hours?", "{P} is {a} years older than {Q}. In {b} years {P} will be twice as old as {Q}. How old is {Q} now?", "Find the sum of {a}, {b} and {c}.",
    "If {a} workers build a wall in {b} days, how many days do {c} workers need?", "{P} reads {a} pages a day. After {b} days {Q} has read {c} pages more than {P}. How many pages did {Q} read?",
    "The price rises from {a} to {b} dollars. By what percentage does it rise?", "A box holds {a} rows of {b} eggs. {P} breaks {c} eggs. How many are left?", "Solve for x: {a} x + {b} = {c}.", "{P} mixes {a} {u} of water with {b} {u} of juice. What share of the drink is juice?",
]


def test_recall_of_other_names_numbers_and_units(spark):
    """Every question again with other values, at the start of a text and inside one: at least 95 % found, verbatim copies all."""
    import random

    rng = random.Random(17)
    names = "Tom Sam Alice Maria Wei Ivan Noor Lena Omar Eva Paul Rosa".split()

    def fill(q):
        n = rng.sample(range(2, 990), 4)
        p = rng.sample(names, 2)
        return q.format(a=n[0], b=n[1], c=n[2], d=n[3], P=p[0], Q=p[1], u=rng.choice(["km", "miles", "litres", "kg"]))

    items = [(k, fill(q)) for k, q in enumerate(QUESTIONS)]
    around = lambda t, m: (t, f"We came to this: {t} That was all.", f"it is said\n{t}\nand more")[m]
    docs = [(100 * k + j, around(fill(q), j % 3)) for k, q in enumerate(QUESTIONS) for j in range(12)] + [(100 * k + 50 + m, around(t, m)) for k, t in items for m in range(3)]
    words = "the a of to in and is it on at by we you from with have some more less water road house tree day year apples".split()
    clean = [(9000 + k, " ".join(rng.choice(words) if rng.random() < 0.75 else rng.choice([str(rng.randrange(99)), rng.choice(names)]) for _ in range(120))) for k in range(150)]
    pairs = decontaminate.contaminated(spark.createDataFrame(docs + clean, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r.doc_id, r.item_id) for r in pairs.collect()}
    other = [(d, d // 100) for d, _ in docs if d % 100 < 50]
    assert all((d, d // 100) in got for d, _ in docs if d % 100 >= 50)
    assert sum(x in got for x in other) >= 0.95 * len(other), [x for x in other if x not in got]
    assert not {d for d, _ in got if d >= 9000} and all(d // 100 == i for d, i in got)


def test_blocks_of_hashes_and_odd_tables(spark):
    items = spark.createDataFrame([*ITEMS, (8, None), (9, ""), (None, "This item has no number but it has words"), (1, ITEMS[0][1])], "item_id long, text string").withColumn("h", F.lit("x"))
    texts = [(k, f"in front {t} behind") for k, t in ITEMS] + [(None, ITEMS[3][1]), (50, None), (51, ""), (4, ITEMS[3][1]), (52, "word " * 200_000 + ITEMS[4][1]), (53, "This item has no number but it has words")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumns({"id": F.lit(1), "pos": F.lit("clash"), "slots": F.lit(2)})
    one = sorted(map(tuple, decontaminate.contaminated(docs, items).collect()), key=str)
    assert one == sorted(map(tuple, decontaminate.contaminated(docs, items, block=7).collect()), key=str)
    assert {r[:2] for r in one} == {(k, k) for k, _ in ITEMS} | {(None, 4), (52, 5), (53, None)}
    none = docs.where("false")
    assert decontaminate.contaminated(none, items).count() == 0 and decontaminate.contaminated(docs, items.where("false")).count() == 0
    left = decontaminate.drop_contaminated(docs, items)
    assert left.columns == docs.columns and sorted((r.doc_id for r in left.collect()), key=str) == [50, 51, None]


#: Questions with numbers in words and glued units; {x} to {z} numbers, {u} a unit that stands at a number with or without a blank.
SPELT = [
    "Sam sold {x} cakes in the morning and {y} cakes after lunch. How many were sold in all?", "There were {x} birds on a wire and {y} flew away. How many birds stayed behind?", "A bag weighs {x}{u} and a crate weighs {y}{u}. What do both of them weigh together?",
    "The tank holds {x}{u} of oil and loses {y}{u} every night. When will it be empty?", "If {x} pens cost {y} coins, what is the cost of {z} pens at this price?", "My brother is {x} years old and my sister is {y}. What is the sum of their ages?",
    "Divide {x} oranges among {y} children so that nobody gets more than another.", "The road is {x}{u} long, and {y}{u} of it have been paved so far. How much is left to pave?", "Each shelf has {x} books and there are {y} shelves in the room. Count all the books.",
    "A recipe for {x} people needs {y}{u} of flour. How much flour is needed for {z} people?", "She ran {x}{u} on Monday and twice as far on the next day. How far did she run?", "From {x} cards we take {y} at random. In how many ways can this be done?",
]


def test_recall_of_spelt_numbers_and_glued_units(spark):
    import random

    rng = random.Random(23)
    say = lambda n: rng.choice([str(n), n_words(n)])

    def n_words(n):
        ones, tens = decontaminate.ONES, decontaminate.TENS
        return ones[n] if n < 20 else tens[n // 10 - 2] + ("-" + ones[n % 10] if n % 10 else "")

    def fill(q, unit):
        x, y, z = rng.sample(range(2, 99), 3)
        if "{u}" in q:
            return q.format(x=x, y=y, z=z, u=unit)
        return q.format(x=say(x), y=say(y), z=say(z))

    items = [(k, fill(q, "kg")) for k, q in enumerate(SPELT)]
    docs = [(100 * k + j, f"Here is one more. {fill(q, rng.choice([' miles', 'km', ' kg', 'lbs']))} Thanks to all.") for k, q in enumerate(SPELT) for j in range(10)]
    docs += [(100 * k + 50, f"so {t} and so on") for k, t in items]
    pairs = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r.doc_id, r.item_id) for r in pairs.collect()}
    other = [(d, d // 100) for d, _ in docs if d % 100 < 50]
    assert all((100 * k + 50, k) in got for k, _ in items) and all(d // 100 == i for d, i in got)
    assert sum(x in got for x in other) >= 0.95 * len(other), [docs[[d for d, _ in docs].index(x[0])][1] for x in other if x not in got][:5]


def test_glued_units_and_spelt_numbers_are_slots():
    import numpy as np

    def codes(text):
        raw = text.encode()
        c, v, slot, by, _ = decontaminate.template(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        return c.tolist(), v.tolist(), slot.tolist()

    assert codes("weighs 5kg now") == codes("weighs 5 kg now") and codes("weighs 5kg now")[2] == [False, True, True, False]
    assert codes("has twenty-five x") == codes("has 25 x") and codes("has Three x")[1] == codes("has 3 x")[1]
    assert codes("the 3rd b2b 7x7km x5kg")[2] == [False, True, True, True, True]  # words with figures that aren't a number with a unit
