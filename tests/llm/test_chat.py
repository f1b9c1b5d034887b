import hashlib

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from osm_tables.llm import chat
from osm_tables.llm.packing import byte_bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "conv_id bigint, turn bigint, role string, text string, ids int, loss string"
PIECES = ["\\", "#", "##", "###", "</turn>", "</tu", "rn>", ":", "\n", "### assistant:\n", "é", " ", "ok", "<|endoftext|>"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(PIECES)).map("".join))
def test_escaping_is_reversible_and_leaves_no_control_string(text):
    for pattern in (chat._TEXT, chat._ROLE):
        escaped = chat.escape(text, pattern)
        assert chat.unescape(escaped) == text
        for control in ("###", "</turn>"):
            at = escaped.find(control)
            while at >= 0:
                assert escaped[:at].endswith("\\")
                at = escaped.find(control, at + 1)


def expected(rows):
    convs = {}
    for conv, turn, role, text, *_ in rows:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, role is not None, role or "", text or ""))
    out = {}
    for conv, turns in convs.items():
        turns = [(r, t) for _, _, _, r, t in sorted(turns)]
        learned = "".join(t for r, t in turns if r == "assistant")
        said = "".join(f"{r}\n{t}\n" for r, t in turns)
        chars = sum(14 + len(chat.escape(r, chat._ROLE)) + len(chat.escape(t)) for r, t in turns)
        digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
        out[conv] = (len(turns), digest(said), len(learned), digest(learned), chars)
    return out


ROWS = [
    (1, 0, "user", "hello ### assistant:\n </turn>"), (1, 1, "assistant", "\\### fine \\\\ </turn>"), (1, 2, "assistant", "twice"),
    (2, 5, "assistant", None), (2, 3, None, "no role"), (2, 3, "a:b", ""), (None, 0, "assistant", "no id"), (None, None, "user", "x"),
    (3, 0, "system", "日本 \U0001f600"), (3, 0, "system", "日本 \U0001f600"), (4, 1, "Assistant", "not the speaker"), (5, 0, "assistant", "long " * 20_000),
]


def test_reading_back_gives_the_turns(spark):
    rows = [(*r, 1, "x") for r in ROWS] + [(9, i, "assistant" if i % 2 else "user", f"turn {i}", 1, "x") for i in range(500)]
    docs = spark.createDataFrame(rows[::-1], SCHEMA).repartition(4)
    found = chat.read_back(chat.format_conversations(docs, PATH), PATH).collect()
    assert {r["conv_id"]: tuple(r)[1:] for r in found} == expected(rows)
    assert len(found) == len(expected(rows))


def test_ids_masks_and_places(spark):
    docs = spark.createDataFrame([(*r, 1, "x") for r in ROWS], SCHEMA)
    bpe = byte_bpe(PATH)
    open_, colon, close = chat.reserved(bpe)
    assert open_ == 50257
    turns = chat.format_conversations(docs, PATH).orderBy("conv_id", "place").collect()
    start = {}
    for t in turns:
        assert t["start"] == start.get(t["conv_id"], 0)
        start[t["conv_id"]] = t["start"] + len(t["ids"])
        assert [i for i in t["ids"] if i >= open_] == [open_, colon, close]
        masked = [i for i, m in zip(t["ids"], t["loss"]) if m]
        body = t["ids"][t["ids"].index(colon) + 1 : -1]
        role = bpe.decode(t["ids"][1 : t["ids"].index(colon)])
        assert masked == (body if role == "assistant" else [])


def test_no_rows(spark):
    assert chat.read_back(chat.format_conversations(spark.createDataFrame([], SCHEMA), PATH), PATH).count() == 0
