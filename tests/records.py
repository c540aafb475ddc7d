"""Raw records for the tests: a valid one of each table, made from the contract."""

from __future__ import annotations

from millrace.plans.contract import compiled

VALUES = {"int": 7, "float": "1.25", "str": "some text", "bool": True}


def record(table: str, **changes) -> dict:
    """The required keys of a table with values of their type; ``changes`` replace or add."""
    own = {c.name: VALUES[c.type] for c in compiled()[table].columns if c.required}
    return own | changes


def bootstrap(players: int = 3) -> dict:
    return {
        "elements": [record("players", id=i, now_cost=55 + i, scout_risk="none") for i in range(1, players + 1)],
        "teams": [record("teams", id=1), record("teams", id=2)],
        "events": [
            record("events", id=i, finished=i < 2, is_current=i == 2, is_next=i == 3, is_previous=i == 1, chip_plays=[{"chip_name": "b", "num_played": 3}] if i == 1 else [], top_element_info={"id": 4, "points": 17} if i == 1 else None)
            for i in (1, 2, 3)
        ],
        "element_types": [record("element_types", id=i, sub_positions_locked=[12]) for i in (1, 2, 3, 4)],
    }


def fixtures() -> list:
    stats = [
        {"identifier": "goals_scored", "h": [{"element": 1, "value": 2}], "a": [{"element": 2, "value": 1}, {"element": 1, "value": 9}]},
        {"identifier": "saves", "h": [], "a": [{"element": 3, "value": 4}]},
    ]
    return [record("fixtures", id=10, event=1, stats=stats), record("fixtures", id=11, event=None, stats=[])]


def live(*ids: int, minutes: int = 90) -> dict:
    return {"elements": [{"id": i, "stats": {"minutes": minutes, "influence": "4.5", "in_dreamteam": False}} for i in ids] + ["odd", {"stats": {}}]}


def history(player: int, rows: int = 2) -> dict:
    return {"history": [record("player_histories", element_id=player, round=r, fixture=r, modified=True) for r in range(1, rows + 1)]}
