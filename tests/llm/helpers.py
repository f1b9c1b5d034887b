"""Small fixtures: texts with every oddity, and words and hashes as plain Python has them."""

import random
import re
import struct

import xxhash

DOCS = "doc_id bigint, text string"
SPACES = " \t\n\x0b\f\r"


def words(text, fold=False):
    text = text or ""
    if fold:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def odd_texts():
    return [
        None, "", " \n\t ", "one", "a a a a a a", "The the THE tHe x", "é　ö 日本 語 \U0001f600 ok", "x" * 3000,
        "same words here again " * 40, "# $ % <b> | *** &&", "line one\nline one\n\nline two\r\nline one", "\x00 \x01 nul",
    ]


def random_text(rng, n, vocabulary=30):
    return "".join(f"w{rng.randrange(vocabulary)}{rng.choice(['', ',', '.', 'É'])}{rng.choice(SPACES)}" for _ in range(n))


def odd_docs(seed=1, n=20):
    rng = random.Random(seed)
    rows = [(i, t) for i, t in enumerate(odd_texts())]
    rows += [(100 + i, random_text(rng, rng.randrange(200))) for i in range(n)]
    rows += [rows[-1], rows[-1], (None, rows[-1][1]), (None, "no id"), (None, None), (100, "another text with the same id")]
    return rows


def xx(value, seed=42):
    """Spark's xxhash64 of a string, an int or a ("long", x)."""
    if isinstance(value, str):
        data = value.encode()
    elif isinstance(value, tuple):
        data = struct.pack("<q", value[1])
    else:
        data = struct.pack("<i", value)
    return xxhash.xxh64_intdigest(data, seed)


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x
