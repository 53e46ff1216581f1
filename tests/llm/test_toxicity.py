import random

from starbrook.llm import toxicity as T


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def brute(terms, word):
    found = set()
    for k, term in enumerate(terms):
        if term.endswith(T.END):
            least = distance(term[:-1], word)
            reached = {least}
        else:
            reached = {distance(term, word[:n]) for n in range(len(word) + 1)}
        if min(reached) <= T.edits_allowed(term):
            found.add((k, min(reached)))
    return found


def test_automaton_against_edit_distance():
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("abc") for _ in range(n))
    terms = sorted({word(rng.randint(3, 10)) + rng.choice(["", T.END]) for _ in range(12)})
    automaton = T.Automaton(terms)
    for _ in range(800):
        asked = word(rng.randint(1, 11))
        best = {}
        for term, edits in automaton.match(asked):
            best[term] = min(edits, best.get(term, 9))
        assert set(best.items()) == brute(terms, asked), asked


def test_quotation_weighs_less():
    odds = [[4.0, 2.0]]
    own = T.Matcher(["idiot" + T.END], odds)
    assert own.features("you idiot !")[0] > own.features('they said "you idiot" to me')[0] > 0
    assert own.features("he wrote idiot")[2] > 0
    assert own.features("a fine day") == [0.0, 0.0, 0.0]
    assert own.features("you idi0t")[0] > 0


def training(spark, n=400):
    rng = random.Random(1)
    words = ["tree", "house", "river", "stone", "cloud", "green", "walks", "sings"]
    rows = []
    for i in range(n):
        text = [rng.choice(words) for _ in range(30)]
        toxic = int(rng.random() < 0.25)
        if toxic:
            for _ in range(3):
                text[rng.randrange(30)] = rng.choice(["morons", "stupid", "worthless"])
        rows.append((i, " ".join(text), toxic))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, x) for i, _, x in rows], "doc_id bigint, toxic int")
    return docs, labels, {i: x for i, _, x in rows}


def test_held_out_accuracy_and_misspellings(spark, odd, none):
    docs, labels, truth = training(spark)
    model = T.learn(docs, labels)
    found = {r.doc_id: r for r in T.score(docs, model).collect()}
    held = [r for r in found.values() if r.held_out]
    assert len(held) > 40 and all(r.predicted == truth[r.doc_id] for r in held)
    asked = spark.createDataFrame([(1, "the stupld tree and worthles river morens"), (2, "the tree")], docs.schema)
    assert {r.doc_id: r.predicted for r in T.score(asked, model).collect()} == {1: 1, 2: 0}
    scored = T.score(odd, model).collect()
    assert len(scored) == odd.count() and all(0 <= r.score <= 1 for r in scored)
    assert len({r.score for r in scored if r.doc_id in (1, 2, 3)}) == 1
    assert T.score(none, model).collect() == []
    kept = T.keep_clean(odd, model)
    assert kept.columns == odd.columns and kept.count() == odd.count()


def test_every_term_with_evidence_is_kept(spark):
    """Many insults, each in few texts; and a family of toxic near-copies, which counts once."""
    rng = random.Random(5)
    letters = lambda n: "".join(rng.choice("abcdefghijklmnoprstuvwz") for _ in range(n))
    insults, words = sorted({letters(8) for _ in range(150)}), [letters(5) for _ in range(200)]
    rows = [(" ".join(rng.choice(words) for _ in range(40)), 0) for _ in range(1200)]
    for k in range(400):
        own = [insults[(6 * k + j) % len(insults)] for j in range(6)]
        rows.append((" ".join(own[j // 6] if j % 6 == 0 else rng.choice(words) for j in range(36)), 1))
    copied = [letters(8) for _ in range(60)]
    for k in range(40):
        rows.append((" ".join([*copied[:30], f"only{k}", *copied[30:]]), 1))
    terms = T.lexicon(spark.createDataFrame(rows, "text string, label int"))
    automaton = T.Automaton(terms)
    assert len(terms) > 100 and all(automaton.match(w) for w in insults)
    assert not [t for t in terms for w in copied if (w + T.END).startswith(t) and not any(i.startswith(t) for i in insults)]


def test_held_out_labels_are_not_read(spark):
    docs, labels, _ = training(spark, 120)
    held = T.training_fold()
    flipped = labels.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 5 = 0 then 1 - toxic else toxic end as toxic")
    assert labels.filter(~held).count() > 0
    assert T.learn(docs, labels) == T.learn(docs, flipped)


def test_without_labels(spark, documents, odd):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    model = T.learn(documents, none)
    assert {r.score for r in T.score(odd, model).collect()} == {0.0}
    assert T.keep_clean(odd, model).count() == odd.count()
