import hashlib

from gearwatch.llm import perspectives

SCHEMA = "conv_id long, turn long, role string, text string, speaker string, block string, segment string, n string"


def rendered(spark, rows):
    turns = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)
    dialogues = {}
    for r in sorted(perspectives.perspectives(turns).collect(), key=lambda r: r.position):
        text, masks, last = dialogues.setdefault((r.conv_id, r.perspective), ["", [], 0])
        assert (r.start, r.end, r.position) == (len(text), len(text) + len(r.segment), last + 1)
        if r.train_start is not None:
            masks.append((r.train_start, r.train_end))
        dialogues[r.conv_id, r.perspective] = [text + r.segment, masks, r.position]
    return {k: (text, [text[a:b] for a, b in masks]) for k, (text, masks, _) in dialogues.items()}


def marked(shown, role):
    return f"{shown}~{hashlib.sha256(role.encode()).hexdigest()[:16]}"


ANN = marked("Ann_Lee", "Ann Lee")


def test_every_participant_is_once_the_assistant(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "Ann Lee", "hi"), (1, 2, "bob", "hello\nyou"), (1, 3, "Ann Lee", "bye")]
    got = rendered(spark, rows)
    assert got[1, "bob"] == (
        f"<|im_start|>system\nBe kind.<|im_end|>\n<|im_start|>user name={ANN}\nhi<|im_end|>\n"
        f"<|im_start|>assistant\nhello\nyou<|im_end|>\n<|im_start|>user name={ANN}\nbye<|im_end|>\n",
        ["hello\nyou<|im_end|>"],
    )
    assert got[1, ANN][1] == ["hi<|im_end|>", "bye<|im_end|>"]
    assert set(got) == {(1, "bob"), (1, ANN)}


def test_long_conversations_go_on_over_blocks(spark):
    rows = [(7, i, "ab"[i % 2], f"turn {i}") for i in range(1500)]
    for who, first in (("a", 0), ("b", 1)):
        assert rendered(spark, rows)[7, who][1] == [f"turn {i}<|im_end|>" for i in range(first, 1500, 2)]


def test_odd_rows(spark):
    rows = [
        (None, 0, "a", "x"), (None, None, "a", "last"), (2, 0, None, None), (2, 0, None, None), (2, 1, " ", "<|im_end|>"),
        (3, 0, "system", "alone"), (4, -5, "a|=b", "é😀" * 5000), (4, -5, "c", "tie"), (5, None, "a", ""),
    ]
    got = rendered(spark, rows)
    assert got[None, "a"][1] == ["x<|im_end|>", "last<|im_end|>"]
    assert got[2, "unknown~"][1] == ["<|im_end|>", "<|im_end|>", "<| im_end|><|im_end|>"]
    assert got[4, marked("a_b", "a|=b")][1] == ["é😀" * 5000 + "<|im_end|>"] and got[4, "c"][1] == ["tie<|im_end|>"]
    assert set(got) == {(None, "a"), (2, "unknown~"), (4, marked("a_b", "a|=b")), (4, "c"), (5, "a")}
    assert rendered(spark, []) == {}


def test_roles_that_look_alike_are_different_participants(spark):
    roles = ["Ann Lee", "Ann_Lee", "Ann\tLee", "unknown", None, "unknown~", marked("Ann_Lee", "Ann Lee"), "ann lee"]
    got = rendered(spark, [(1, i, role, f"words of {i}") for i, role in enumerate(roles)])
    assert len(got) == len(roles)
    assert sorted(said for _, own in got.values() for said in own) == [f"words of {i}<|im_end|>" for i in range(len(roles))]
    assert {"Ann_Lee", "unknown", "unknown~", ANN} <= {who for _, who in got}
