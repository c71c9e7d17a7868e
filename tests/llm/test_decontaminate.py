from tickbars.llm import decontaminate as D

DOCS = "doc_id long, text string, item_id string, pos int"
ITEM = "A train leaves Paris at 9 hours with 120 passengers and returns to Paris after 3 days with 80 of them on board."


def docs(spark, texts):
    return spark.createDataFrame([(k, t, "x", 1) for k, t in enumerate(texts)], DOCS)


def bench(spark, texts):
    return spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "item_id long, text string")


def test_verbatim_reparameterised_and_clean(llm):
    other = ITEM.replace("Paris", "London").replace("120", "300").replace("9", "7").replace("3 days", "5 weeks")
    clash = ITEM.replace("returns to Paris", "returns to Lyon")
    texts = [f"before it. {ITEM} after", f"Some words first.\n{other}", f"Once {clash}", "nothing of the kind here", None, "",
             " ".join(f"w{i}" for i in range(500)), ITEM.upper()]
    got = {r.doc_id: r for r in D.decontaminate(docs(llm, texts), bench(llm, [ITEM, "too short"])).collect()}
    assert set(got) >= {0, 1} and not set(got) & {3, 4, 5, 6}
    assert got[0].same_values and not got[1].same_values
    # one item value that stands for two document values is no copy with other values
    assert 2 not in got


def test_short_items_and_repeats(llm):
    item = "zip zap zop boing bang"
    texts = ["x zip zap zop boing bang y", "zip zap zop", f"{item} {item}"]
    df = docs(llm, texts)
    got = sorted((r.doc_id, r.item_id) for r in D.decontaminate(df.union(df), bench(llm, [item, "a b c", None])).collect())
    assert got == [(0, 0), (2, 0)]


def test_stage_keeps_rows_and_columns(llm):
    df = docs(llm, [ITEM, "clean text here", None, ""])
    kept = D.keep_clean(df, bench(llm, [ITEM]))
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 3]
    assert D.decontaminate(df.filter("false"), bench(llm, [ITEM])).count() == 0
    assert D.decontaminate(df, bench(llm, [ITEM]).filter("false")).count() == 0


def test_canonical_words():
    assert D.canonical(b"3.5%,")[0] == D.NUMBER and D.canonical(b"12km")[0] == D.NUMBER
    assert D.canonical(b"hours.")[0] == D.UNIT and D.canonical(b"(Paris)")[:2] == (D.NAME, "Paris")
    assert D.canonical(b"|")[0] == D.BREAK and D.canonical("été!".encode()) == (D.LITERAL, "été", True)


def test_plain_words_are_told_without_patterns(monkeypatch):
    """Words of letters, maybe with a stop, are what a text is made of: no search for numbers or outer punctuation."""
    class Never:
        def fullmatch(self, core):
            raise AssertionError(core)

    monkeypatch.setattr(D, "_NUMBER", Never())
    monkeypatch.setattr(D, "_QUANTITY", Never())
    for word, kind, core, ends in (
            ("word", D.LITERAL, "word", False), ("word,", D.LITERAL, "word", False), ("word;", D.LITERAL, "word", True),
            ("été.", D.LITERAL, "été", True), ("A", D.LITERAL, "A", False), ("Paris?!", D.NAME, "Paris", True),
            ("McDonald", D.NAME, "McDonald", False), ("Élan,", D.NAME, "Élan", False), ("KM", D.UNIT, "KM", False),
            ("Hours.", D.UNIT, "Hours", True), ("Twelve", D.NUMBER, "Twelve", False), ("second", D.UNIT, "second", False),
            ("一二", D.LITERAL, "一二", False), ("ǅ", D.LITERAL, "ǅ", False)):
        assert D.canonical(word.encode()) == (kind, core, ends), word


def found(spark, texts, items):
    return {(r.doc_id, r.item_id): r.same_values for r in D.decontaminate(docs(spark, texts), bench(spark, items)).collect()}


def test_items_dense_in_values(llm):
    """Windows with few literal words count, and items of few words are looked up whole."""
    items = ["Alice paid Bob 5 dollars and Carol 7 euros", "A rectangle is 12 cm by 8 cm by 5 cm and weighs 3 kg",
             "What is gravity?", "Bob owes 5 euros", "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16"]
    texts = [f"they say {x} to all" for x in items] + [
        f"Something else. {items[2]}\nAnd on.", f"First line\n{items[3]}", "gravity is what it is", "Bob owes 7 euros",
        "So a rectangle is 40 cm by 30 cm by 20 cm and weighs 9 kg in all", "8 9 1 2 5 5 1 2 8 16 3 11 2 1 1 4 9"]
    assert found(llm, texts, items) == {(0, 0): True, (1, 1): True, (4, 4): True, (5, 2): True, (6, 3): True, (9, 1): False}


def test_openers_number_words_and_other_names(llm):
    """A soft word is read as a value and as an ordinary word."""
    tom = "Tom has 3 red apples. Sue buys 5 more pears. Ann eats 2 of them. Jim wants all."
    mac = "the farmer McDonald sells twelve old horses to O'Brien and Jean-Luc brings three of them back to the USA again"
    new = mac.replace("McDonald", "MacLeod").replace("twelve", "nine").replace("O'Brien", "Smith-Jones") \
        .replace("Jean-Luc", "d'Arcy").replace("three", "4").replace("USA", "UK")
    planet = "Which planet is known as the red planet"
    twice = "The cost is what we paid then for all of it. The rest was left to him and then to her"
    texts = [tom.replace("Tom", "Ben").replace("Sue", "Eva").replace("Ann", "Kim").replace("Jim", "Max"), new,
             f"and they asked {planet} again", mac.upper(), twice.replace("The cost", "A cost"),
             tom.replace("Tom", "Ben").replace("Sue", "Eva").replace("Ann eats", "Ann sells").replace("2 of", "2 or")]
    assert found(llm, texts, [tom, mac, planet, twice]) == {
        (0, 0): False, (1, 1): False, (2, 2): True, (3, 1): True, (4, 3): True}


def test_keep_clean_shuffles_only_texts_that_may_go(llm):
    """A clean text reaches the anti join of no shuffle; null texts and repeated rows stay as they came."""
    texts = [f"Some other text of number {k} on its own" for k in range(60)]
    df = llm.createDataFrame([(k, t) for k, t in enumerate([*texts, ITEM, None, None, texts[0]])], "doc_id long, text string")
    kept = D.keep_clean(df, bench(llm, [ITEM]))
    assert sorted(r.doc_id for r in kept.collect()) == [k for k in range(64) if k != 60]
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lstrip().startswith("Union") and plan.count("LeftAnti") == 1
