"""Quotation linking."""

from __future__ import annotations

import pytest
from odd_documents import LONG, prepared  # noqa: F401
from orestar.llm import quotes


def linked(spark, rows):
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "id bigint, text string, own string, depth int")
    return {r.id: (r.root, r.parent, r.depth, r.own) for r in quotes.link_quotations(table).collect()}


def test_nested_levels_and_reply_order(spark):
    found = linked(
        spark,
        [
            (1, "Shall we meet?"),
            (2, "> Shall we  MEET?\nYes, at noon."),
            (3, "> > Shall we meet?\n> Yes, at noon.\nFine."),
            (4, ">> Yes, at noon.\n> Fine.\n\nSee you\n"),
            (5, "> a quote of nobody\n> > Yes, at noon.\nMe too"),
            (6, "nothing quoted"),
        ],
    )
    assert found == {
        1: (1, None, 0, "Shall we meet?"),
        2: (1, 1, 1, "Yes, at noon."),
        3: (1, 2, 2, "Fine."),
        4: (1, 3, 3, "See you"),
        5: (1, 2, 2, "Me too"),
        6: (6, None, 0, "nothing quoted"),
    }


def test_parts_of_messages_are_found(spark):
    found = linked(
        spark,
        [
            (1, "first paragraph of some length\n> quoted in between\nsecond paragraph of some length"),
            (2, "> second paragraph of some length\nagreed"),
            (3, "> a line that is not there\n> first paragraph of some length\nso so"),
        ],
    )
    assert found[2][:3] == (1, 1, 1) and found[3][:3] == (1, 1, 1)


def test_equal_texts_belong_to_the_earliest(spark):
    rows = [(i, "the same hello") for i in range(1, 30)] + [(40, "> the same hello\nhi"), (0, "> the same hello\ntoo early")]
    found = linked(spark, rows)
    assert found[40][:3] == (1, 1, 1)
    assert found[0][:3] == (0, None, 0)


def test_repeated_passages_stay_in_their_conversation(spark):
    found = linked(
        spark,
        [
            (1, "question one"),
            (2, "> question one\nThanks"),
            (3, "question two"),
            (4, "> question two\nthanks"),
            (5, "> > question two\n> thanks\nwelcome"),
            (6, "thanks\n> question two"),
            (7, "you too\n> thanks\n> > question two"),
            (8, "question three"),
            # What it thanks for was not quoted where it was said.
            (9, "> > question three\n> thanks\nbye"),
            (10, "> thanks\nno more"),
        ],
    )
    assert [found[i][:3] for i in (4, 5, 7, 9, 10)] == [(3, 3, 1), (3, 4, 2), (3, 4, 2), (8, 8, 1), (1, 2, 2)]


def test_a_long_thread(spark):
    rows = [(0, "message 0")] + [(i, f"> message {i - 1}\nmessage {i}") for i in range(1, 70)]
    assert {i: r[:3] for i, r in linked(spark, rows).items()} == {i: (0, i - 1 if i else None, i) for i in range(70)}


def test_odd_messages(spark):
    found = linked(
        spark, [(1, None), (2, ""), (3, "> \n>\n"), (4, LONG), (5, f"> {LONG}\nlong"), (6, "same"), (6, "same"), (6, "other"), (7, ">>>"), (8, "> other\nx")]
    )
    assert found[5][:3] == (4, 4, 1) and found[8][:3] == (6, 6, 1)
    assert [found[i] for i in (1, 2, 3, 7)] == [(i, None, 0, "") for i in (1, 2, 3, 7)]
    assert found[6][3] == "other"
    table = spark.createDataFrame([(None, "a"), (None, None), (1, "> a\nb")], "id bigint, text string")
    rows = sorted(map(tuple, quotes.link_quotations(table).collect()), key=repr)
    assert rows == [(1, 1, None, 0, "b"), (None, None, None, 0, ""), (None, None, None, 0, "a")]


def test_no_messages(spark):
    assert quotes.link_quotations(spark.createDataFrame([], "id bigint, text string")).count() == 0


def test_mails_quote_what_came_before(spark):
    turns = [(1, 0, "a\nb"), (1, 1, "> c"), (1, 2, None), (2, 5, "d"), (None, 1, "x")]
    table = spark.createDataFrame(turns, "conv_id bigint, turn bigint, text string")
    found = {tuple(r.id): r.text for r in quotes.mails_of(table).collect()}
    assert found == {(1, 0): "a\nb", (1, 1): "> a\n> b\n > c", (1, 2): "> > a\n> > b\n>  > c\n", (2, 5): "d"}


@pytest.mark.parametrize("text", ["plain", "> one", "> > two\n> one\nown\n>>> three"])
def test_parts_cover_every_line(spark, text):
    table = spark.createDataFrame([(1, text)], "id int, text string")
    (row,) = quotes.passages(table, "id", "text").collect()
    assert sum(p.said.count("\n") + 1 for p in row.parts) == text.count("\n") + 1
