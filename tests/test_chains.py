from __future__ import annotations

import json
import random

import pytest

from apptflow.operators.chains import chain_positions
from apptflow.operators.conferences import PAGE_BITS, page_chain, user_chain_positions


def walk(links: list[tuple[int | None, int | None]], first: int, end: int = -1):
    """What the rules say, one step at a time."""
    least: dict[int, int | None] = {}
    for i, n in links:
        if i is not None:
            known = least.get(i, n)
            least[i] = n if i not in least else min((x for x in (known, n) if x is not None), default=None)
    place, at = {}, first
    while at in least and at not in place:
        place[at] = len(place)
        at = least[at]
    pointed = {n for n in least.values() if n is not None and n != end}
    rows = set()
    for i, n in least.items():
        seen, at = [], n
        while at in least and at != i and at not in seen:
            seen.append(at)
            at = least[at]
        part = "listed" if i in place else "cut off" if i in pointed else "second head"
        rows.add((i, n, place.get(i), part, at == i))
    return rows


def found(spark, links, first=0):
    table = spark.createDataFrame(links, "id long, next_id long")
    rows = [tuple(r) for r in chain_positions(table, first).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


CHAINS = {
    "empty": [],
    "one": [(0, -1)],
    "itself": [(0, 0)],
    "no first": [(1, 2), (2, -1)],
    "null ends": [(0, 1), (1, None), (None, 3)],
    "landed twice": [(0, 1), (0, 1), (1, -1), (1, 2), (2, -1)],
    "missing": [(0, 7), (7, 9), (3, 4), (4, -1)],
    "late cycle": [(0, 5), (5, 3), (3, 8), (8, 5), (1, 2), (2, 3)],
    "own cycle": [(0, -1), (4, 5), (5, 6), (6, 4), (9, 4)],
    "many heads": [(0, 50), *[(i, 50) for i in range(1, 50)], (50, 51), (51, -1)],
}


@pytest.mark.parametrize("name", CHAINS)
def test_places_by_the_rules(spark, name):
    assert found(spark, CHAINS[name]) == walk(CHAINS[name], 0)


@pytest.mark.parametrize("seed", range(3))
def test_places_in_random_links(spark, seed):
    rng = random.Random(seed)
    ids = rng.sample(range(1000), 60)
    links = list(zip(ids, [*ids[1:], rng.choice([-1, ids[rng.randrange(60)]])], strict=True))
    for _ in range(seed * 4):
        k = rng.randrange(60)
        links[k] = (links[k][0], rng.choice([*ids, -1, 5000]))
    assert found(spark, links, ids[0]) == walk(links, ids[0])


def test_users_come_in_the_order_of_the_chain(spark):
    def page(number, following, *users):
        body = {"next_page_id": following, "users": [{"id": u, "status": 1} for u in users]}
        return number, json.dumps(body)

    pages = [page(7, 2, "a", "b"), page(2, 9, "c"), page(9, -1, "d"), page(4, 9, "x"), (None, "{}"), (11, "oops")]
    table = spark.createDataFrame(pages, "page_id long, body string")
    users = {r.id: r.list_pos for r in user_chain_positions(table, 7).collect()}
    assert users == {"a": 0, "b": 1, "c": 1 << PAGE_BITS, "d": 2 << PAGE_BITS, "x": None}
    parts = {r.page_id: r.part for r in page_chain(table, 7).collect()}
    assert parts == {7: "listed", 2: "listed", 9: "listed", 4: "second head", 11: "second head"}
