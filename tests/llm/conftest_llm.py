"""Small helpers and row builders of the tests."""

import random

#: Further columns under names that the operators use inside.
CLASH = "rk string, node long, size long, key string, value long, text_ string, n int, fp long, dk long, ord long, path_ string, dir string"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + CLASH
N_CLASH = CLASH.count(",") + 1


def near_copies(seed: int, count: int = 60) -> list[str]:
    """Texts with exact copies, copies with a few changed words, shared passages and
    passages repeated within a text."""
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdeiou") for _ in range(rnd.randint(1, 6))) for _ in range(300)]
    passage = " ".join(rnd.choice(words) for _ in range(40))
    out: list[str] = []
    for _ in range(count):
        kind = rnd.random()
        if out and kind < 0.2:
            out.append(rnd.choice(out))
        elif out and kind < 0.45:
            text = rnd.choice(out).split(" ")
            for _ in range(rnd.randint(1, 4)):
                text[rnd.randrange(len(text))] = rnd.choice(words)
            out.append(" ".join(text))
        else:
            text = [rnd.choice(words) for _ in range(rnd.randint(1, 150))]
            if rnd.random() < 0.3:
                text.insert(rnd.randrange(len(text) + 1), passage)
            if rnd.random() < 0.2:
                text += text[: len(text) // 2]
            out.append(" ".join(text))
    return out


ODD_TEXTS = [
    None,
    "",
    " \n\t",
    "!!! ???",
    "one",
    "One one ONE",
    "ä ö ü ß",
    "été à la mer naïve 中文字 😀",
    "a" * 400,
    "ab" * 300,
    "x y " * 60,
    "long " + " ".join(str(i) for i in range(5000)),
    "nul \x00 byte \x1f unit",
    "Released under the MIT License.\nmore text follows here.",
    "word.with,punctuation;and(brackets) don't I'll <|endoftext|> x",
]


def rows(texts: list[str | None], first: int = 0) -> list[tuple]:
    langs, sources = ["en", "de", None], ["s1", "s0", None, "s2"]
    return [(first + i, t, langs[i % 3], sources[i % 4] if i % 5 else "s1", None) + ("x",) + (1,) * 0 + tuple([None] * (N_CLASH - 1)) for i, t in enumerate(texts)]


def key(value):
    """Sorts nulls first."""
    return (value is not None, value if value is not None else 0)
