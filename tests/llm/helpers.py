"""Small documents with the awkward cases, and columns whose names the operators also use inside."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, hash string, `class` string, size int, spans string, kind string, part int, `at` int, n_words string, items string"


def awkward(seed: int = 1, n: int = 60) -> list[tuple]:
    rng = random.Random(seed)
    vocab = ["the", "Of", "and", "a", "tion", "été", "ß", "日本", "x1", "No.", "end!", "ID"]
    texts: list[str | None] = [None, "", "   \n\t ", "one", "one two", "one  two\n", "ONE two", "!!! ---", "İstanbul K", "a\x01b\x02c"]
    base = " ".join(rng.choice(vocab) + str(rng.randrange(40)) for _ in range(120))
    texts += [base, base, base + " ", base.replace(" ", "\n"), base.upper()]
    words = base.split(" ")
    for k in range(0, 40, 4):
        changed = list(words)
        for j in range(k // 4):
            changed[7 + 11 * j] = "CHANGED"
        texts.append(" ".join(changed))
    while len(texts) < n:
        texts.append(rng.choice([" ", "\n", "\t \x0b"]).join(rng.choice(vocab) + str(rng.randrange(9)) for _ in range(rng.randrange(1, 60))))
    texts.append("word " * 30000 + "é")
    langs, sources = ["en", "fr", None], ["s1", "s2", "ſ", "", None]
    rows = [(100 - k, t, langs[k % 3], sources[k % 5]) for k, t in enumerate(texts)]
    rows += [rows[12], rows[12], (None, "one", "en", "s1"), (None, None, None, None)]
    return [(*r, None if r[1] is None else len(r[1]), "h", "c", 1, "s", "k", 2, 3, "w", "i") for r in rows]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)
