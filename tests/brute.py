"""Plain-Python histories that the Spark results are compared with."""


def scd2(events, tracked):
    """events: (key, sequence, operation, payload dict). Returns (key, payload items, start, end)."""
    out, by_key = [], {}
    for key, seq, op, payload in events:
        by_key.setdefault(key, {})[seq] = (op, payload)
    for key, of_key in by_key.items():
        opened = None
        for seq in sorted(of_key):
            op, payload = of_key[seq]
            same = opened and op != "D" and all(opened[0][c] == payload[c] for c in tracked)
            if same:
                opened = (payload, opened[1])
                continue
            if opened:
                out.append((key, tuple(sorted(opened[0].items())), opened[1], seq))
            opened = None if op == "D" else (payload, seq)
        if opened:
            out.append((key, tuple(sorted(opened[0].items())), opened[1], None))
    return sorted(out, key=repr)


def from_snapshots(snapshots, tracked):
    """snapshots: {version: {key: payload dict}}; a key missing from a version is deleted there."""
    keys = {k for rows in snapshots.values() for k in rows}
    events = [
        (k, v, "U" if k in snapshots[v] else "D", snapshots[v].get(k, {})) for k in keys for v in sorted(snapshots)
    ]
    return scd2(events, tracked)
