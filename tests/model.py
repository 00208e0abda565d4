"""A plain-Python model of the reports, written from the semantic rules
(trip ends, both-direction time table, half-even rounding, per-file grain,
unweighted means of per-file values, NULL handling, station tie-break).
Used as a brute-force oracle on small random inputs."""

from __future__ import annotations

from collections import defaultdict


def _mean(xs):
    xs = [x for x in xs if x is not None]
    return sum(xs) / len(xs) if xs else None


def _round(x):
    # Python's round() on a float is half-even.
    return None if x is None else int(round(x))


def _mid(a, b):
    return None if a is None or b is None else (a + b) / 2.0


def _order(score, station):
    return (score is None, -(score or 0), station is not None, station or 0)


def per_file_stations(trips, user_type):
    """{(file, station): dict of measures} from (file, t, o, d, u) trips."""
    acc = defaultdict(lambda: {"n": 0, "from": [], "to": [], "n_from": 0, "n_to": 0})
    for f, t, o, d, u in trips:
        if user_type is not None and u != user_type:
            continue
        a = acc[(f, o)]
        a["n"] += 1
        a["n_from"] += 1
        a["from"].append(t)
        b = acc[(f, d)]
        b["n"] += 1
        b["n_to"] += 1
        b["to"].append(t)
    return acc


def _top_per_file(rows, score, k):
    """rows: {(file, station): tuple}; returns [(file, rank, station, *tuple)]."""
    by_file = defaultdict(list)
    for (f, s), vals in rows.items():
        by_file[f].append((s, vals))
    out = []
    for f, items in by_file.items():
        items.sort(key=lambda it: _order(score(it[1]), it[0]))
        for rank, (s, vals) in enumerate(items[:k], start=1):
            out.append((f, f[:6], rank, s, *vals))
    return out


def _top(rows, score, k):
    items = sorted(rows.items(), key=lambda it: _order(score(it[1]), it[0]))
    return [(s, *vals) for s, vals in items[:k]]


def time_table(acc, rounded):
    out = {}
    for key, a in acc.items():
        if a["n_from"] and a["n_to"]:
            tf, tt = _mean(a["from"]), _mean(a["to"])
            out[key] = (_round(tf), _round(tt)) if rounded else (tf, tt)
    return out


def connection_time_table(acc, rounded):
    out = {}
    for key, a in acc.items():
        if rounded:
            tf = _round(_mean([None if t is None else round(t) for t in a["from"]]))
            tt = _round(_mean([None if t is None else round(t) for t in a["to"]]))
        else:
            tf, tt = _mean(a["from"]), _mean(a["to"])
        out[key] = (a["n"], _mid(tf, tt))
    return out


def reports(trips, variant, k_file, k_total):
    user_type = 1 if variant == "v3" else None
    rounded = variant != "v1"
    acc = per_file_stations(trips, user_type)
    out = {}
    times = time_table(acc, rounded)
    out["top_times"] = _top_per_file(times, lambda v: _mid(*v), k_file)
    if variant == "v3":
        conn = {key: (a["n"],) for key, a in acc.items()}
        out["top_connections"] = _top_per_file(conn, lambda v: v[0], k_file)
    else:
        ct = connection_time_table(acc, rounded)
        out["top_connections"] = _top_per_file(ct, lambda v: v[0], k_file)
    if variant == "v1":
        return out
    by_station = defaultdict(list)
    if variant == "v2":
        for (f, s), (n, mt) in connection_time_table(acc, True).items():
            by_station[s].append((n, mt))
        totals = {
            s: (_round(_mean([n for n, _ in v])), _round(_mean([mt for _, mt in v])))
            for s, v in by_station.items()
        }
    else:
        for (f, s), a in acc.items():
            by_station[s].append(a["n"])
        totals = {s: (_round(_mean(v)),) for s, v in by_station.items()}
    out["total_connections"] = _top(totals, lambda v: v[0], k_total)
    per_station_times = defaultdict(list)
    for (f, s), (tf, tt) in time_table(acc, True).items():
        per_station_times[s].append((tf, tt))
    tot_times = {
        s: (_round(_mean([a for a, _ in v])), _round(_mean([b for _, b in v])))
        for s, v in per_station_times.items()
    }
    out["total_times"] = _top(tot_times, lambda v: _mid(*v), k_total)
    return out
