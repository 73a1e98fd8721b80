"""Identifiers found through contexts, and through contexts that only found ones stand in."""

from pyspark.sql import functions as F

from opsight.llm import pii


def test_found_identifiers_give_rise_to_new_patterns(spark):
    texts = [f"call me: 10.0.{i // 100}.{i % 100} now" for i in range(200)]
    first = len(texts)
    # no base match, and no known one has this layout of digits
    texts += [f"call me: 9999.0.0.{i} via" for i in range(15)]
    second = len(texts)
    # beside nothing that a base match stands in
    texts += ["write 88888.0.0.1 via", "write 88888.0.0.2 by"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.personal_data(docs).collect()}
    for i in range(first, second):
        assert got[i].n_ip == 0 and got[i].spans == f"ip:9:{len(texts[i]) - 4}"
    assert got[second].spans == "ip:6:17" and got[second + 1].spans == ""
    cards = [(i, f"paid {n} times") for i, n in enumerate(["4111111111111111", "4012888888881881", "12", "3"])]
    got = {r.doc_id: r.spans for r in pii.personal_data(spark.createDataFrame(cards, "doc_id long, text string")).collect()}
    assert got[2] == got[3] == ""


def test_five_generations_are_found(spark):
    """Known ones alone are too small a share of every pattern but the first; each needs the generation before."""
    texts = []

    def known(left, right, n):
        for _ in range(n):
            i = len(texts)
            alone = "".join(chr(ord("a") + int(d)) for d in str(i))  # a word beside no other
            texts.append(f"{left or 'p' + alone} 10.0.{i // 250}.{i % 250} {right or 'q' + alone}")

    known("me:", None, 300), known(None, "one", 160), known("two", None, 50), known(None, "three", 25), known("four", None, 10)
    began = len(texts)
    generations = [("me:", "one", 30), ("two", "one", 10), ("two", "three", 5), ("four", "three", 2), ("four", "end", 1)]
    for g, (left, right, n) in enumerate(generations):
        texts += [f"{left} {9000 + g}.0.0.{i} {right}" for i in range(n)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_ip, r.spans) for r in pii.personal_data(docs).collect()}
    assert all(got[i][0] == 1 for i in range(began))
    assert all(got[i][0] == 0 and got[i][1].startswith("ip:") for i in range(began, len(texts)))


def test_neighbours_at_any_distance(spark):
    long = "x" * 5000
    text = f"{long}y {' ' * 300}12 \n 34a, {long}z"
    row = spark.createDataFrame([(text,), ("",), ("7",)], "text string").select(pii.candidates(F.col("text")).alias("c")).collect()
    assert [(m["value"], m["left"], m["right"]) for m in row[0].c] == [("12", long + "y", "0a,"), ("34a", "0", long + "z")]
    assert row[1].c == [] and [(m["start"], m["end"], m["left"], m["right"]) for m in row[2].c] == [(0, 1, "", "")]


def test_a_text_of_very_many_matches(spark):
    """Positions stay right, and the time linear, over a hundred thousand matches."""
    import re
    import time

    text = " ".join(f"a{'é' * (i % 3)} {i}" for i in range(100_000))
    table = spark.createDataFrame([(1, text), (2, ""), (3, "7"), (4, "no digits")], "id long, text string")
    began = time.time()
    got = {r.id: r.found for r in table.select("id", pii._found(F.col("text"), pii.WORD, "[0-9@]").alias("found")).collect()}
    assert time.time() - began < 60
    assert [(m["start"], m["end"], m["value"]) for m in got[1]] == [(m.start(), m.end(), m.group()) for m in re.finditer(r"[0-9]+", text)]
    assert got[2] == [] and got[4] == [] and [(m["start"], m["end"]) for m in got[3]] == [(0, 1)]
