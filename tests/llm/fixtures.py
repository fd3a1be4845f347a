"""Small documents with every odd case: nulls, empty and long texts, ties, copies, repeated rows, extra columns with clashing names."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_tokens string, kept string, size string, piece string, component_id string, copies string, score string, n_lines string"
WORDS = "the of and to in is it that for was on are as with his they at be this from have or by one had not but what all were when we there can an your which their said if do will each about how up out them then she many some so these would other into has more her two like him see time could no make than first been its who now people my made over did down only way find use may water long little very after words called just where most know".split()


def passages(seed: int = 0) -> list[tuple]:
    r = random.Random(seed)
    say = lambda n: " ".join(r.choice(WORDS) for _ in range(n))
    base, shared = say(200), say(60)
    line = "This line stands in many of the documents, word for word"
    texts = [say(r.randrange(25, 120)) for _ in range(12)]
    texts += [base, base, base, " ".join(base.split()[:199]), base.replace(" the ", " a ", 2)]
    texts += [f"{say(30)}. {shared} {say(30)}" for _ in range(5)]
    texts += [f"{say(12)}\n{line}\n{say(10)}\n  {line.upper()}  \n{say(3)}" for _ in range(4)]
    texts += [None, "", " ", "\n\n", "one", "two words", "a  b", "é" * 30, "漢字かな交じり文 " * 20, "x" * 5000, "same same " * 400, say(4000), "# $ % " * 50, "<|endoftext|> tail", "A\nB\nA\nB\nA\nB " + say(20)]
    rows = [(i, t, ("en", "fr", None)[i % 3], ("s1", "s1", "s2", None)[i % 4]) for i, t in enumerate(texts)]
    return rows


def documents(spark, rows=None, repeat: bool = False):
    rows = passages() if rows is None else rows
    rows = rows + ([rows[0], rows[12]] if repeat else [])
    return spark.createDataFrame([(i, t, lang, source, len(t or ""), "x", "x", "x", "x", "x", "x", "x", "x") for i, t, lang, source in rows], SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
