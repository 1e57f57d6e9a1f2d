import random

import numpy as np
from pyspark.sql import functions as F
from tallyhouse.llm import toxicity as T


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def nearest(word, lexicon):
    found = []
    for entry, stem in lexicon.items():
        ways = [word[:n] for n in range(len(word) + 1)] if stem else [word]
        d = min(distance(w, entry) for w in ways)
        if d <= T.allowed(entry, stem):
            found.append((d, entry))
    return (min(found)[1], min(found)[0]) if found else None


def test_automaton_against_edit_distances():
    pick = random.Random(8)
    lexicon = {"idiot": False, "moron": False, "scum": False, "worthless": False, "lowei": True, "lostra": True, "abc": False, "abcde": False, "chllac": True}
    for limit in (50_000, 3):
        automaton = T.Automaton(lexicon, limit)
        asked = list(lexicon) + ["", "i", "idiots", "1d10t", "loweitum", "lstrabc", "wurthles", "wrthlss"]
        for _ in range(1500):
            w = list(pick.choice(list(lexicon)))
            for _ in range(pick.randint(0, 3)):
                at = pick.randrange(len(w) + 1)
                w[at : at + pick.randint(0, 1)] = pick.choices("abcdeilmost", k=pick.randint(0, 1))
            asked.append("".join(w) + "".join(pick.choices("abe", k=pick.randint(0, 2))))
        for w in asked:
            assert automaton.match(w) == nearest(w, lexicon), w


def made(n, seed):
    pick = random.Random(seed)
    base = ["".join(pick.choices("abcdefgh", k=pick.randint(3, 9))) for _ in range(300)]
    bad = ["vilebeast", "rottenfool", "dimwit"]
    rows = []
    for i in range(n):
        text, toxic = pick.choices(base, k=30), i % 4 == 0
        if toxic:
            for w in pick.choices(bad, k=3):
                text.insert(pick.randrange(30), w)
        elif i % 4 == 1:  # the same words, quoted and reported
            text[10:10] = ["they", "wrote", '"you', pick.choice(bad), 'there"', "reported"]
        rows.append((i, " ".join(text), int(toxic)))
    return rows


def test_quotation_is_told_from_abuse_and_misspellings_are_found(spark):
    train, held = made(800, 1), made(200, 1)[:0] + made(1000, 1)[800:]
    docs = spark.createDataFrame([(i, t) for i, t, _ in train + held], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in train], "doc_id long, toxic int")
    model = T.fit(docs, labels, F.lit(True))
    assert {"vilebeast", "rottenfool", "dimwit"} <= {*model.lexicon}
    got = {r.doc_id: r for r in T.score(docs, model).collect()}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    assert np.mean([got[i].predicted == y for i, _, y in held]) > 0.95
    scorer = T.Scorer(model)
    plain = "fae bcd gha dimwit hed rottenfool gab vilebeast fed"
    assert scorer.score(plain.replace("rottenfool", "rotenfool").replace("vilebeast", "vilebaest").replace("dimwit", "dimwitt")) > 0.5
    assert scorer.score('fae bcd they wrote "you dimwit there" reported gab fed') < 0.5
    assert scorer.score("fae bcd gha hed gab fed") < 0.5


def test_edge_rows(spark, docs):
    rows = [(1, None), (2, ""), (3, "word " * 50_000), (4, "x"), (4, "x"), (None, "y")]
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    labels = spark.createDataFrame([(3, 1), (3, 0), (9, 1), (None, 1), (4, None), (1, 0)], "doc_id long, toxic int")
    for some in (empty, labels):
        model = T.fit(docs(rows), some, F.lit(True))
        got = T.score(docs(rows), model).collect()
        assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
        kept = T.keep(docs(rows), model)
        assert kept.columns == docs(rows).columns and kept.count() == sum(not r.predicted for r in got)
    assert T.score(docs([]), model).collect() == []


def test_held_out_labels(spark):
    """Some labels mark texts without any telling word, so not every toxic text can be found."""
    from tallyhouse.llm import queries

    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    got = [(r.predicted, labels[r.doc_id]) for r in queries.op1_toxicity(spark, folder).collect() if r.held_out and r.doc_id in labels]
    assert np.mean([p for p, y in got if y]) > 0.9
    assert np.mean([p for p, y in got if not y]) < 0.01
