"""The cascade row by row in plain Python: slow, literal, and independent of Spark."""

from collections import namedtuple

Listing = namedtuple("Listing", "player_id player_name_api team_name name")
Value = namedtuple("Value", "name eur raw")


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def last_name(name):
    return None if name is None else name.split(" ")[-1]


def value_order(eur, raw):
    return (eur is None, -(eur or 0.0), raw is None, raw or "")


def cascade(roster, values):
    """(exact, initial, fuzzy, no_match) as lists of (player_id, name_api, team, eur, raw)."""

    def level(rows, key):
        found, left = [], []
        for r in rows:
            k = key(r.name)
            hits = [v for v in values if k is not None and key(v.name) == k]
            for v in hits or [Value(None, None, None)]:
                if v.eur is None:
                    left.append(r)
                else:
                    found.append((r.player_id, r.player_name_api, r.team_name, v.eur, v.raw))
        return found, left

    exact, left = level(roster, lambda n: n)
    initial, left = level(left, lambda n: None if n is None else (last_name(n), n[:1]))

    best = {}
    for r in left:
        block = [v for v in values if r.name is not None and last_name(v.name) == last_name(r.name)]
        for v in block or [Value(None, None, None)]:
            d = distance(r.name, v.name) if block else None
            order = (
                (d is not None, d or 0),
                (v.name is not None, v.name or ""),
                value_order(v.eur, v.raw),
                r.team_name,
                r.player_name_api,
            )
            if r.player_id not in best or order < best[r.player_id][0]:
                best[r.player_id] = (order, d, r, v)
    near = [(r, v) for _, d, r, v in best.values() if d is not None and d <= 3]
    fuzzy = [(r.player_id, r.player_name_api, r.team_name, v.eur, v.raw) for r, v in near if v.eur is not None]
    no_match = [(r.player_id, r.player_name_api, r.team_name, 0.0, "0") for r, v in near if v.eur is None]
    return exact, initial, fuzzy, no_match
