"""A small corpus with the cases that operators must define: nulls, empty and long texts, copies, repeated rows, clashing columns."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, node long, n_docs string"


def sentence(rng, n, words):
    return " ".join(rng.choice(words) for _ in range(n))


def texts(seed=5, n=60):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(400)] + ["the", "of", "and", "to", "in", "is", "de", "la"] * 12
    shared = [sentence(rng, 9, words).capitalize() + "." for _ in range(4)]
    out = []
    for i in range(n):
        lines = [sentence(rng, rng.randint(5, 25), words).capitalize() + "." for _ in range(rng.randint(2, 9))]
        if i % 3 == 0:
            lines.insert(rng.randint(0, len(lines)), rng.choice(shared) if i % 2 else "  " + rng.choice(shared).upper() + "\t")
        out.append("\n".join(lines))
    for i in range(0, 20, 2):  # exact and near copies
        out.append(out[i])
        w = out[i].split(" ")
        for _ in range(max(1, len(w) // 60)):
            w[rng.randrange(len(w))] = "zz"
        out.append(" ".join(w))
    out += ["", " \n\t", "one", "one two", "one  two\n", "a b c d", "x " * 3000, "\n".join([shared[0]] * 3), "Ünïcode ÄÖÜ ä " + chr(0x2028) + "ok", "A" * 50_000]
    return out


def rows(seed=5, n=60):
    out = [(i, t, "en" if i % 3 else "de", f"s{i % 4}", len(t), "k", i, "x") for i, t in enumerate(texts(seed, n))]
    out.append((1000, None, None, None, None, None, None, None))
    out.append((None, out[3][1], "en", "s", 5, "k", 1, "x"))
    out.append(out[5])  # a repeated row
    return out


def frame(spark, seed=5, n=60, parts=3):
    return spark.createDataFrame(rows(seed, n), SCHEMA).repartition(parts)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
