import random

from meterlark.llm import decontam

QUESTION = (
    "A train leaves the old station of Porto at 9 and runs 120 km towards Lisbon. "
    "Yesterday the driver Maria stopped for 15 minutes in Coimbra. How many km does Maria drive after the stop in Coimbra?"
)
OTHER = QUESTION.replace("120 km", "75 miles").replace("Maria", "Pedro").replace("15 minutes", "40 minutes").replace("Coimbra", "Aveiro")
MIXED = QUESTION
for name in ("Maria", "Coimbra"):  # one value of the item becomes several of the text
    for new in ("Anna", "Braga", "Clara"):
        MIXED = MIXED.replace(name, new, 1)
FILL = "some words that have nothing to do with it and go on for a while "


def frames(spark, texts, items):
    docs = spark.createDataFrame([(k, t, "clash") for k, t in enumerate(texts)], "doc_id long, text string, item_id string")
    return docs, spark.createDataFrame(list(enumerate(items)), "item_id long, text string")


def test_words_are_classified():
    w = decontam.words_of("It cost 3.50 dollars, said Ann. Then SHE ran 12 km in May")
    assert [(w.value(k).decode(), int(w.kinds[k])) for k in range(len(w.kinds)) if w.kinds[k]] == [
        ("3.50", decontam.NUMBER), ("dollars", decontam.UNIT), ("ann", decontam.NAME), ("12", decontam.NUMBER), ("km", decontam.UNIT), ("may", decontam.NAME)
    ]
    w = decontam.words_of("Über Äpfel. École à Évian")
    assert [w.value(k).decode() for k in range(len(w.kinds)) if w.kinds[k] == decontam.NAME] == ["äpfel", "évian"]


def test_copies_and_new_parameters_are_found_and_mixed_ones_are_not(spark):
    texts = [FILL + QUESTION, FILL + OTHER + " " + FILL, FILL + MIXED, FILL, QUESTION.upper().lower(), None, "", "the train leaves", (FILL * 900) + QUESTION, QUESTION, QUESTION]
    docs, items = frames(spark, texts, [QUESTION, "too few", None])
    got = {r.doc_id: (r.contaminated, r.item_ids, r.n_items) for r in decontam.report(docs, items).collect()}
    clean = (False, [], 0)
    held = (True, [0], 1)
    assert got == {0: held, 1: held, 2: clean, 3: clean, 4: held, 5: clean, 6: clean, 7: clean, 8: held, 9: held, 10: held}


def test_agreement_tells_why(spark):
    block = decontam.Block([(0, QUESTION)])
    words = decontam.words_of(MIXED)
    item = block.words[0]
    hits = [(k, k) for k in range(len(item.hashes) - decontam.WORDS + 1)]
    values, agreeing = block.agreement(words, item, hits)
    assert (values, agreeing) == (4, 2)
    assert block.agreement(decontam.words_of(OTHER), item, hits)[0] == values == block.agreement(decontam.words_of(OTHER), item, hits)[1]


def test_equals_brute_force_on_texts_without_placeholders(spark):
    rng = random.Random(4)
    words = [f"w{'abcdefghij'[k]}{'klmnopqrst'[j]}" for k in range(10) for j in range(10)]
    items = [" ".join(rng.choice(words) for _ in range(rng.randint(3, 30))) for _ in range(30)]
    texts = []
    for _ in range(200):
        text = [rng.choice(words) for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.5:
            passage = rng.choice(items).split()
            passage = passage[: int(len(passage) * rng.choice([0.5, 0.85, 1]))]
            text[5:5] = passage
        texts.append(" ".join(text))
    docs, bench = frames(spark, texts, items)

    def windows(t):
        w = t.split()
        return {tuple(w[k : k + 5]) for k in range(len(w) - 4)}

    want = {d: [i for i, x in enumerate(items) if windows(x) and len(windows(x) & windows(t)) >= 0.8 * len(windows(x))] for d, t in enumerate(texts)}
    assert {r.doc_id: r.item_ids for r in decontam.report(docs, bench).collect()} == want
    assert any(want.values())


def test_blocks_give_the_same_result(spark, monkeypatch):
    docs, items = frames(spark, [QUESTION, OTHER + FILL, FILL * 3], [QUESTION, FILL, FILL, OTHER])
    whole = sorted(map(tuple, decontam.report(docs, items).collect()))
    monkeypatch.setattr(decontam, "BLOCK_WINDOWS", 10)
    assert len(list(decontam.blocks(items))) > 3
    assert sorted(map(tuple, decontam.report(docs, items).collect())) == whole


def test_empty_tables(spark):
    docs, items = frames(spark, [QUESTION], [QUESTION])
    assert [r.contaminated for r in decontam.report(docs, items.where("false")).collect()] == [False]
    assert decontam.report(docs.where("false"), items).count() == 0
    assert decontam.mark(docs, items).columns == ["doc_id", "text", "item_id", "held_items"]


def test_copies_after_other_words_on_other_lines_and_in_capitals_are_found(spark):
    short = "Which rivers cross the old town"
    lines = "Some of the oldest towns of Portugal that the river Douro meets lie near Porto while others that travellers like lie near Coimbra or Braga"
    texts = ["He asked, " + short + " and left", 'the heading\n"' + short + '"', FILL + short.replace("rivers", "roads").replace("old", "new"),
             lines.replace(" Portugal", "\nPortugal").replace(" Douro", "\nDouro").replace(" Braga", "\nBraga"), QUESTION.upper()]
    docs, items = frames(spark, texts, [short, lines, QUESTION])
    got = {r.doc_id: r.item_ids for r in decontam.report(docs, items).collect()}
    assert got == {0: [0], 1: [0], 2: [], 3: [1], 4: [2]}


def test_copies_with_other_capitals_dashes_and_sentence_ends_are_found(spark):
    item = "Maria buys 3 apples and gives the Lisbon baker half of them before she walks home to Porto where her friend Maria waits for her"
    texts = [
        item.lower(), item.upper(), item.title(), item.replace("Maria", "MARIA"), "so, she said. " + item[0].lower() + item[1:], item.replace(" and ", " - and "),
        item.replace("Lisbon", "lisbon. ").replace("she", "She"), item.replace("3", "17").lower(), item.replace("Maria", "Pedro"), item.replace("friend Maria", "friend Pedro"),
        item.lower().replace("apples", "pears").replace("walks", "runs").replace("waits", "sings"), " ".join(reversed(item.split())), FILL * 40,
    ]
    docs, items = frames(spark, [t if k % 2 else FILL + t + " " + FILL for k, t in enumerate(texts)], [item, "What is the capital of France"])
    got = {r.doc_id: r.item_ids for r in decontam.report(docs, items).collect()}
    assert got == {k: [0] if k < 9 else [] for k in range(13)}
    docs, items = frames(spark, ["what is the capital of france", "What Is The Capital Of France?", "what is the capital of spain"], ["What is the capital of France"])
    assert {r.doc_id: r.contaminated for r in decontam.report(docs, items).collect()} == {0: True, 1: True, 2: False}


def test_a_name_that_begins_the_item_has_a_value():
    item = "Maria has 3 apples and asks where the baker Maria met yesterday may have gone"
    block = decontam.Block([(7, item)])
    assert block.held(item) == [(7, 11, 11, 2, 2)]
    assert block.held("Then Pedro" + item[5:].replace("Maria", "Pedro")) == [(7, 11, 11, 2, 2)]
    assert block.held(item.replace("baker Maria", "baker Pedro")) == []


def test_short_items_are_held_by_texts_of_the_same_words(spark):
    docs, items = frames(spark, ["Who wrote it?", "who - wrote it", "so who wrote it", "who wrote", "", None, "..."], ["who wrote it", "Who wrote it", "", "?"])
    assert {r.doc_id: r.item_ids for r in decontam.report(docs, items).collect()} == {0: [0, 1], 1: [0, 1], 2: [], 3: [], 4: [], 5: [], 6: []}


def test_equals_brute_force_with_names_and_numbers():
    rng = random.Random(8)
    plain, names = [f"w{a}{b}" for a in "abcdef" for b in "ghij"], ["Anna", "Berta", "Carl", "Dora"]

    def sentence(n):
        words = [rng.choice(names) if rng.random() < 0.15 else str(rng.randint(1, 9)) if rng.random() < 0.1 else rng.choice(plain) for _ in range(n)]
        return " ".join(words)

    def kinds(text):
        return ["#" if w.isdigit() else "N" if k and w in names else w.lower() for k, w in enumerate(text.split())]

    def unnamed(text):
        return ["#" if w.isdigit() else w.lower() for w in text.split()]

    def windows(words):
        return [tuple(words[k : k + 5]) for k in range(len(words) - 4)]

    found = 0
    for _ in range(300):
        item = sentence(rng.randint(5, 25))
        copy = item.split()
        for _ in range(rng.randint(0, 2)):
            copy[rng.randrange(len(copy))] = rng.choice(plain)
        copy = " ".join(copy)
        text = rng.choice([copy, copy.lower(), copy.upper(), sentence(30)])
        # The item's first word may also stand for a name.
        readings = list(zip(windows(kinds(item)), windows(unnamed(item)), strict=True))
        has = set(windows(kinds(text))) | set(windows(unnamed(text)))
        begun = ("N", *kinds(item)[1:5]) if item.split()[0] in names else None
        shares = {t for k, (t, u) in enumerate(readings) if t in has or u in has or (k == 0 and begun in has)}
        want = len(shares) >= 0.8 * len({t for t, _ in readings})
        got = decontam.Block([(1, item)]).held(text)
        assert not got or want, (item, text)
        if want and not got:  # only values that do not agree may undo it
            words = decontam.words_of(item)
            assert words.slots().any() and text.lower() != item.lower(), (item, text)
        found += bool(got)
    assert found > 60
