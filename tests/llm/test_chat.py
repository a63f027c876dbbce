from cabtally.llm.chat import conversations, maximal, op10_chat_format, rendered

TURNS = "conv_id long, turn int, role string, text string"


def final(spark, rows, schema=TURNS):
    return rendered(maximal(conversations(spark.createDataFrame(rows, schema))))


def plain(turns):
    return "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in turns)


def test_snapshots_fall_into_the_longest(spark):
    talk = [("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "d")]
    rows = [(n, k, *talk[k]) for n in (1, 2, 3, 4) for k in range(n)]
    rows += [(9, k, *talk[k]) for k in range(4)]  # equal to 4
    rows += [(5, 0, "user", "a"), (5, 1, "assistant", "other")]  # branches off
    rows += [(6, 0, "userassistant", ""), (7, 0, "user", "assistanta")]  # not equal when joined
    rows += [(8, 1, "assistant", "b"), (8, 0, "user", "a")]  # a snapshot in another order
    got = {r.conv_id: r for r in final(spark, rows).collect()}
    assert set(got) == {4, 5, 6, 7}
    assert got[4].text == plain(talk) and got[4].n_turns == 4 and got[4].answer_chars == 2


def test_nulls_ties_repeats_markers_and_other_columns(spark):
    rows = [(1, 0, "user", "x", 1), (1, 0, "user", "x", 2), (1, None, "system", None, 3), (1, 1, None, "<|im_end|>", 4),
            (None, 0, "user", "alone", 5), (None, 7, "user", "alone", 6), (2, 0, "user", "", 7)]
    got = {(r.conv_id, r.text) for r in final(spark, rows, TURNS + ", hashes int").collect()}
    assert got == {
        (1, plain([("system", ""), ("user", "x"), ("unknown", "<| im_end|>")])),
        (None, plain([("user", "alone")])),
        (2, plain([("user", "")])),
    }


def test_long_conversations(spark):
    rows = [(c, k, "user", f"t{k}") for c, n in ((1, 400), (2, 399), (3, 1)) for k in range(n)]
    assert [r.conv_id for r in final(spark, rows).collect()] == [1]


def test_query_against_brute_force(spark, small, rows_of):
    talks = {}
    for conv, turn, role, text in rows_of("conversations", "conv_id, turn, role, text", small):
        talks.setdefault(conv, set()).add((turn, role, text))
    talks = {c: [(r, t) for _, r, t in sorted(x)] for c, x in talks.items()}
    want = set()
    for c, talk in talks.items():
        longer = any(len(o) > len(talk) and o[: len(talk)] == talk for o in talks.values())
        first = min(d for d, o in talks.items() if o == talk)
        if not longer and c == first:
            want.add((c, len(talk), plain(talk)))
    got = {(r.conv_id, r.n_turns, r.text) for r in op10_chat_format(spark, small).collect()}
    assert got == want
