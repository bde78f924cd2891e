from collections import defaultdict

from wayline.llm.chat import perspectives


def test_every_view_of_every_dialogue(spark):
    rows = [(1, k, ("user", "ann b", "system", "user")[k % 4], f"t{k} é") for k in range(200)]
    rows += [(2, 0, "system", "alone"), (3, None, None, None), (3, 5, "", "x"), (3, 5, "z", "y"), (None, 1, "q", "r"), (1, 7, "user", "t"), (1, 7, "user", "t")]
    got = defaultdict(list)
    for r in perspectives(spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, key int")).collect():
        got[r.conv_id, r.speaker].append(r)
    name = lambda role: (role or "").replace(" ", "_") or "unknown"
    seen = set()
    for conv in {r[0] for r in rows}:
        said = sorted(((t is None, t or 0, name(role), text or "") for c, t, role, text in rows if c == conv))
        for speaker in {x[2] for x in said} - {"system"}:
            seen.add((conv, speaker))
            whole, masks = "", []
            for _, _, who, text in said:
                role = "system" if who == "system" else "assistant" if who == speaker else "user"
                head = f"<|{role}{' name=' + who if role == 'user' else ''}|>\n"
                if role == "assistant":
                    masks.append((len(whole) + len(head), len(whole) + len(head) + len(text) + len("<|end|>\n")))
                whole += head + text + "<|end|>\n"
            view = sorted(got[conv, speaker], key=lambda r: r.start)
            assert "".join(r.rendered for r in view) == whole
            assert [(r.mask_start, r.mask_end) for r in view if r.role == "assistant"] == masks
    assert set(got) == seen


def test_no_rows(spark):
    assert perspectives(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
