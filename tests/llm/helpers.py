"""Small tables with nulls, empty and long texts, ties, repeated rows and columns whose names clash with the operators' own."""

import random
import re


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, key string, `row` long, n long, fp long, rid long, slice string"


def words(r: random.Random, n: int) -> str:
    return " ".join("".join(r.choice("abcdefghé") for _ in range(r.randint(1, 7))) for _ in range(n))


def table(seed: int = 1, n: int = 60) -> list[tuple]:
    r = random.Random(seed)
    shared = words(r, 45)
    texts = [words(r, r.choice([0, 1, 2, 3, 4, 5, 34, 35, 36, 80, 200])) for _ in range(n)]
    texts += [None, "", " ", "\t\n", "x", "x  y", "x y", "x\ty", "x y", "é" * 300, "a b " * 60, words(r, 6000)]
    texts += [shared, f"{words(r, 9)} {shared} {words(r, 8)}", f"{shared}\n{shared}", texts[7], texts[7], texts[9], texts[9].replace(" ", "\n") if texts[9] else texts[9]]
    near = words(r, 300).split()
    for k in range(4):
        texts.append(" ".join([*near[:150], *([f"zz{k}"] if k else []), *near[150:]]))
    rows = []
    for k, t in enumerate(texts):
        rows.append((3 * k + 1, t, r.choice(["en", "fr", None]), r.choice(["a", "b", "ö", None, "z"]), len(t or ""), True, "k", 1, 2, 3, 4, "s"))
    return [*rows, rows[5], rows[5], rows[-1]]


def frame(spark, rows: list[tuple]):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def split(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def rows_of(df) -> list[dict]:
    return df.toArrow().to_pylist()


