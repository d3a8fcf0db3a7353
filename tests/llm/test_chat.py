from layerwell.llm.chat import chunks, perspectives

SCHEMA = "conv_id long, turn long, role string, text string, start int, salt string"
ROWS = [
    (1, 0, "system", "be kind", 0, "x"), (1, 1, "ann", "hi é🙂", 0, "x"), (1, 2, "bob", None, 0, "x"), (1, 3, "ann", "", 0, "x"),
    (1, 3, "ann", "", 0, "x"), (1, None, None, "early", 0, "x"), (2, 0, "system", "alone", 0, "x"), (None, 5, "cy", "own", 0, "x"),
    (None, 4, "dee", "own too", None, None), (3, 7, "solo", "z" * 500_000, 0, "x"),
]


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = [(r[1], r[2] or "unknown", r[3] or "") for r in rows if r[0] == conv]
        for me in {name for _, name, _ in turns} - {"system"}:
            seen = []
            for turn, name, text in turns:
                role = "system" if name == "system" else "assistant" if name == me else "user"
                head = f"<|im_start|>{role}" + (f" name={name}" if role == "user" else "") + "\n"
                seen.append((turn is not None, turn or 0, name, f"{head}{text}<|im_end|>\n", role, len(head), turn))
            at, out[conv, me] = 0, []
            for _, _, name, segment, role, head, turn in sorted(seen, key=lambda s: s[:4]):
                mask = (at + head, at + len(segment) - 1) if role == "assistant" else (None, None)
                out[conv, me].append((turn, role, name, segment, at, at + len(segment), *mask))
                at += len(segment)
    return out


def test_rotation_equals_brute_force(spark):
    got = {}
    for r in perspectives(spark.createDataFrame(ROWS, SCHEMA).repartition(3)).collect():
        got.setdefault((r.conv_id, r.perspective), []).append(tuple(r)[2:])
    assert {k: sorted(v, key=lambda s: s[4]) for k, v in got.items()} == brute(ROWS)


def test_one_very_long_conversation(spark):
    rows = [(9, i, "ab"[i % 2], f"turn {i}", 0, "x") for i in range(5000)]
    rendered = perspectives(spark.createDataFrame(rows, SCHEMA))
    text = {}
    for r in chunks(rendered, 4096).orderBy("perspective", "chunk").collect():
        assert r.start == len(text.get(r.perspective, "")) and len(r.text) < 4096 + 100
        for m in r.masks:
            assert r.text[m.mask_start - r.start : m.mask_end - r.start].endswith("<|im_end|>")
        text[r.perspective] = text.get(r.perspective, "") + r.text
    want = {me: "".join(s[3] for s in v) for (_, me), v in brute(rows).items()}
    assert text == want


def test_no_rows(spark):
    assert perspectives(spark.createDataFrame([], SCHEMA)).collect() == []
