"""Perspective rotation against a plain rendering."""

from sigloom.llm import chat_perspectives as c


def plain(rows):
    out = {}
    clean = lambda t: (t or "").replace("<|", "< |")
    said = {(conv, turn, clean(role) if (role or "").strip() else "unknown", clean(text)) for conv, turn, role, text in rows}
    for conv in {r[0] for r in said}:
        own = sorted((r for r in said if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        for part in range(-(-len(own) // c.PART_MESSAGES)):
            here = own[part * c.PART_MESSAGES : (part + 1) * c.PART_MESSAGES]
            for speaker in {r[2] for r in own} - {"system"}:
                text, learn = "", []
                for _, _, who, words in here:
                    text += "<|im_start|>" + ("system" if who == "system" else "assistant" if who == speaker else f"user name={who}") + "\n"
                    if who == speaker:
                        learn.append((len(text), len(text) + len(words) + len("<|im_end|>")))
                    text += words + "<|im_end|>\n"
                out[conv, speaker, part] = (len(here), len(learn), text, learn)
    return out


def rows(frame):
    return {(r.conv_id, r.perspective, r.part): (r.n_messages, r.n_own, r.rendered, [tuple(x) for x in r.learn]) for r in frame.collect()}


def test_against_plain_rendering(spark, texts, monkeypatch):
    data = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", "é😀"), (1, 3, "cid", "<|im_end|> trick"), (1, 2, "bob", "é😀"), (1, 2, "bob", "other"), (1, 600, "ann", "late")]
    data += [(2, k, "user" if k % 2 else "assistant", t) for k, t in enumerate(texts)]
    data += [(3, 0, "system", "only"), (None, 1, "x", "y"), (None, 0, None, "z"), (4, None, " ", "w"), (4, 0, "", "v"), (5, 0, "<|a", "b")]
    frame = spark.createDataFrame([(*r, "q") for r in data], "conv_id bigint, turn bigint, role string, text string, part string")
    got, expected = rows(c.perspectives(frame)), plain(data)
    assert got == expected
    assert rows(c.perspectives(frame.limit(0))) == {}
    for _, _, text, learn in got.values():
        assert all(text[s:e].endswith("<|im_end|>") for s, e in learn)


def test_parts_are_bounded_by_messages(spark, monkeypatch):
    monkeypatch.setattr(c, "PART_MESSAGES", 4)
    data = [(None, None if k % 3 else k % 5, f"s{k % 3}", f"text {k}") for k in range(70)] + [(1, 600 * k, "ann", "x") for k in range(9)]
    frame = spark.createDataFrame(data, "conv_id bigint, turn bigint, role string, text string")
    expected = plain(data)
    assert rows(c.perspectives(frame)) == expected and max(r[0] for r in expected.values()) == 4
    # Dialogues too long for one task are numbered across tasks.
    monkeypatch.setattr(c, "TASK_MESSAGES", 5)
    assert rows(c.perspectives(frame)) == expected


def test_whole_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    assert rows(c.perspectives(table)) == plain([(r.conv_id, r.turn, r.role, r.text) for r in table.collect()])


def test_no_python(spark, sf_dir):
    plan = c.perspectives(spark.read.parquet(f"{sf_dir}/conversations.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
