"""Small hard inputs that the tests share."""

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [f"w{i}" for i in range(300)]


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], SCHEMA)


def make_corpus():
    """Copies, near copies, shared lines, a hot source, empty, null and long texts."""
    draw = random.Random(11)
    prose = lambda n: " ".join(draw.choice(WORDS) for _ in range(n))
    texts = [prose(draw.randrange(1, 120)) for _ in range(60)]
    for i in range(25):
        words = texts[i % 5].split()
        for _ in range(draw.randrange(0, 5)):
            words[draw.randrange(len(words))] = draw.choice(WORDS)
        texts.append(" ".join(words).replace(" ", draw.choice([" ", "  ", "\n"]), 3))
    shared = "A line that many documents share, Longer than Forty characters"
    texts += [f"{prose(10)}\n {shared if i % 2 else shared.upper()}\n{prose(5)}\n{shared}" for i in range(8)]
    texts += [texts[0], texts[0], "", None, " \n\t ", "é" * 5, "one two", "ONE  two", prose(9000), None]
    texts += [texts[-2] + " tail", "日本 ▁ x  y" * 3]
    return [(i, t, None if i % 17 == 0 else "hot" if i % 3 else f"s{i % 4}") for i, t in enumerate(texts)]


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def toxic_corpus(spark):
    draw = random.Random(8)
    rows, labels = [], []
    for i in range(400):
        words = [draw.choice(WORDS) for _ in range(80)]
        bad = i % 4 == 0
        for k in range(0, 80, 10) if bad else ():
            words[k] = draw.choice(["idiot", "scum", "moron"])
        rows.append((i, " ".join(words), "s"))
        labels.append((i, 1, int(bad)))
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
