"""Small tables with the awkward cases: nulls, empty and long texts, ties, repeated rows,
extra columns whose names are those that operators use inside."""
import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, name string, fp long, key string, rid long"
ENGLISH = "the of and to in is that for it with as was on are by this from have not but".split()
FRENCH = "le la les des une est que dans pour qui sur pas avec au par plus ce il sont".split()
LICENSE = "Released under the MIT License. See the Apache License, Version 2.0 and the GNU General Public License v3."


def sentence(rng, words, n):
    made = [rng.choice(words) + rng.choice(["", "", "er", "on", "ti"]) for _ in range(n)]
    return " ".join(made).capitalize() + "."


def documents(n=60, seed=3):
    """Plain tuples (doc_id, text, lang)."""
    rng = random.Random(seed)
    shared = [sentence(rng, ENGLISH, 14) for _ in range(2)]
    rows = []
    for i in range(n):
        words, lang = (ENGLISH, "en") if i % 3 else (FRENCH, "fr")
        lines = [sentence(rng, words, rng.randint(3, 25)) for _ in range(rng.randint(1, 6))]
        if i % 4 == 0:
            lines.insert(0, f" \t{shared[0].upper() if i % 8 else shared[0]}\r")
        if i % 9 == 0:
            lines += [shared[1], shared[1]]
        if i % 11 == 0:
            lines.append(LICENSE)
        rows.append((i, "\n".join(lines), lang))
    by_id = dict((r[0], r) for r in rows)
    copy = by_id[5][1]
    rows += [(100, copy, "en"), (101, copy.replace(" ", " \t\n"), "en"), (102, copy + " ", None),
             (103, copy.rsplit(" ", 1)[0], "en"), (104, None, "en"), (105, "", None), (106, "  \n\n ", "fr"),
             (107, "123 -- !!", "en"), (108, "Éİ K ſ " + LICENSE, "en"), (109, "one two three", "en"),
             (110, " ".join(sentence(rng, ENGLISH, 30) for _ in range(900)) + LICENSE, "en"),
             (None, by_id[7][1], "en"), (None, None, None), (111, "\n\n", "fr"), (111, "\n\n", "fr"),
             (112, shared[0] + "\nx", "en"), (112, shared[0] + "\ny", "en")]
    return rows


def table(spark, rows):
    full = [(i, t, lang, None, len(t) if t is not None else None, "n", 7, "k", 1) for i, t, lang in rows]
    return spark.createDataFrame(full, SCHEMA)
