"""Quotation links against a plain version over written messages."""

import random
import re

from stopwise.llm import quotations

SCHEMA = "conv_id long, turn long, role string, text string, own string"


def plain(messages):
    """Reply and thread of each message with a conversation and a turn."""

    def passages(text):
        found, last = [], None
        for line in re.split(r"\r\n|\n|\r", text or ""):
            prefix = re.match(r"(?:[ \t]*>)+[ \t]?", line)
            level, body = (prefix[0].count(">"), line[prefix.end() :]) if prefix else (0, line)
            key = -1 if not body.strip(" ") else level
            if key == last:
                found[-1][1].append(body)
            else:
                found.append((key, [body]))
            last = key
        return [(k, re.sub(r"\s+", " ", " ".join(b)).strip().lower()) for k, b in found if k >= 0]

    originals = {}
    for conv, turn, _, text, _ in messages:
        for level, body in passages(text):
            if level == 0:
                originals[conv, body] = min(turn, originals.get((conv, body), turn))
    reply = {}
    for conv, turn, _, text, _ in messages:
        linked = [(-level, originals[conv, body]) for level, body in passages(text) if level and originals.get((conv, body), turn) < turn]
        if linked:
            reply[conv, turn] = max([reply[conv, turn]] if (conv, turn) in reply else [] + linked, default=None)
            reply[conv, turn] = max(linked)
    reply = {k: v[1] for k, v in reply.items()}
    began = {(c, t) for (c, _), t in reply.items()}

    def thread(conv, turn):
        if (conv, turn) not in reply:
            return turn if (conv, turn) in began else None
        while (conv, turn) in reply:
            turn = reply[conv, turn]
        return turn

    return {(c, t): (reply.get((c, t)), thread(c, t)) for c, t, *_ in messages}


def test_nested_quotations_link_and_leave_the_text(spark):
    rows = [
        (1, 0, "user", "Where is the station?\n\nI have little time.", "x"),
        (1, 1, "assistant", "> Where is the  STATION?\n\nOver there.", "x"),
        (1, 2, "user", "Something else entirely.", "x"),
        (1, 3, "user", "On Monday someone wrote:\n>> Where is the station?\n> Over there.\nThanks!", "x"),
        (2, 1, "user", "> Where is the station?\nNot in this conversation.", "x"),
        (1, 4, "user", "> I never said that\nQuoting nothing.", None),
        (3, 0, "user", None, "x"),
        (None, 0, "user", "> Where is the station?", "x"),
        (3, None, "user", "Where is the station?", "x"),
    ]
    found = quotations.link_quotations(spark.createDataFrame(rows, SCHEMA)).collect()
    by_key = {(r.conv_id, r.turn): r for r in found}
    assert len(found) == len(rows)
    assert by_key[1, 1].reply_to == 0 and by_key[1, 1].text == "Over there."
    assert by_key[1, 3].reply_to == 1 and by_key[1, 3].text == "Thanks!" and by_key[1, 3].n_linked == 2
    assert [by_key[1, t].thread for t in range(5)] == [0, 0, None, 0, None]
    assert [by_key[1, t].position for t in range(5)] == [2, 3, 0, 4, 1]
    assert by_key[2, 1].reply_to is None and by_key[2, 1].n_quotes == 1
    assert by_key[1, 4].reply_to is None and by_key[3, 0].text is None and by_key[3, 0].position == 0
    assert by_key[None, 0].position is None and by_key[3, None].position is None


def test_random_threads_agree_with_the_plain_version(spark):
    draw = random.Random(3)
    bodies = [f"Sentence {draw.choice('abc')} number {k}." for k in range(12)]
    rows = []
    for conv in range(6):
        for turn in range(15):
            lines = []
            for _ in range(draw.randint(0, 5)):
                prefix = draw.choice(["", "", "> ", ">> ", "> > > ", ">"])
                lines.append(prefix + draw.choice([draw.choice(bodies), draw.choice(bodies).upper(), ""]))
            rows.append((conv, turn, "user", draw.choice(["\n", "\r\n"]).join(lines), None))
    rows += rows[:5]
    found = quotations.link_quotations(spark.createDataFrame(rows, SCHEMA)).collect()
    expected = plain(rows)
    assert {(r.conv_id, r.turn): (r.reply_to, r.thread) for r in found} == expected
    for conv in range(6):
        mine = sorted((r for r in found if r.conv_id == conv), key=lambda r: r.position)
        assert [r.position for r in mine] == list(range(len(mine)))
        at = {r.turn: r.position for r in mine}
        assert all(at[r.reply_to] < r.position for r in mine if r.reply_to is not None)


def test_quoted_lines_of_longer_passages_link(spark):
    rows = [
        (1, 0, "user", "First line.\nSecond line.\nThird line.\nFourth line.", None),
        (1, 1, "user", "> second LINE.\n> Third line.\nYes.", None),
        (1, 2, "user", "> Fourth line.\nNo.", None),
        (1, 3, "user", "> First line.\n> Third line.\nThese are no neighbours.", None),
        (1, 4, "user", "On Monday someone wrote:\nAll is well.\n> Yes.", None),
        (1, 5, "user", "> All is well.\nGood.", None),
        (2, 0, "user", "> Second line.\nElsewhere.", None),
    ]
    found = quotations.link_quotations(spark.createDataFrame(rows, SCHEMA), parts=True).collect()
    assert {(r.conv_id, r.turn): (r.reply_to, r.n_linked) for r in found} == {
        (1, 0): (None, 0),
        (1, 1): (0, 1),
        (1, 2): (0, 1),
        (1, 3): (None, 0),
        (1, 4): (1, 1),
        (1, 5): (4, 1),
        (2, 0): (None, 0),
    }
    assert quotations.link_quotations(spark.createDataFrame([], SCHEMA), parts=True).count() == 0


def test_empty_table(spark):
    assert quotations.link_quotations(spark.createDataFrame([], SCHEMA)).count() == 0


def plain_links(messages):
    """Earliest original of each quoted passage by comparing all passages and runs of lines; reply and number of links."""

    def passages(text):
        found, last = [], None
        for line in (text or "").split("\n"):
            prefix = re.match(r"(?:[ \t]*>)+[ \t]?", line)
            level, body = (prefix[0].count(">"), line[prefix.end() :]) if prefix else (0, line)
            key = -1 if not body.strip(" ") else level
            if key == last:
                found[-1][1].append(body.lower())
            else:
                found.append((key, [body.lower()]))
            last = key
        return [p for p in found if p[0] >= 0]

    expected = {}
    for conv, turn, _, text, _ in messages:
        links = {}
        for level, body in passages(text):
            if level:
                earlier = [
                    t for c, t, _, x, _ in messages if c == conv and t < turn
                    for other, own in passages(x) if other == 0
                    if own == body or any(own[k : k + len(body)] == body for k in range(len(own) - len(body) + 1))
                ]
                if earlier:
                    links[level, " ".join(body)] = min(earlier)
        expected[conv, turn] = (max(((-lv, t) for (lv, _), t in links.items()), default=(0, None))[1], len(links))
    return expected


def test_parts_agree_with_the_plain_version(spark):
    draw = random.Random(9)
    rows = []
    for conv in range(4):
        for turn in range(14):
            lines = []
            for _ in range(draw.randint(0, 4)):
                prefix = draw.choice(["", "", "> ", ">> "])
                lines += [prefix + f"Line {draw.choice('ab')}{draw.choice('cd')}" for _ in range(draw.randint(1, 7))] + [""] * draw.randint(0, 1)
            rows.append((conv, turn, "user", "\n".join(lines), None))
    found = quotations.link_quotations(spark.createDataFrame(rows, SCHEMA), parts=True).collect()
    assert {(r.conv_id, r.turn): (r.reply_to, r.n_linked) for r in found} == plain_links(rows)


def test_very_long_messages_and_equal_passages(spark):
    long = [f"Line number {k % 9000}" for k in range(10_000)]
    rows = [
        (1, 0, "user", "\n".join(long), None),
        (1, 1, "user", "\n".join(long), None),
        (1, 2, "user", "\n".join("> " + x for x in long[500:5500]) + "\nYes.", None),
        (1, 3, "user", "> " + long[77] + "\n\n> " + "\n> ".join(long[8990:9010]) + "\n\n> \n\nNo.", None),
        (1, 4, "user", "> nothing\n" * 3, None),
        (2, 0, "user", "", None),
    ]
    found = quotations.link_quotations(spark.createDataFrame(rows, SCHEMA), parts=True).collect()
    assert {r.turn: (r.reply_to, r.n_linked, r.n_quotes) for r in found if r.conv_id == 1} == {
        0: (None, 0, 0), 1: (None, 0, 0), 2: (0, 1, 1), 3: (0, 2, 2), 4: (None, 0, 1)
    }
    assert {r.turn: r.text for r in found if r.turn in (2, 3, 4)} == {2: "Yes.", 3: "No.", 4: ""}
