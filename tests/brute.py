"""Plain-Python session rules to compare the Spark operators with."""

from collections import defaultdict


def sessions(events, gap_ms, cap_ms, policy, boundary=frozenset()):
    """Map event id -> (session id, start, end) for ``(user, ms, event_id)`` events."""
    by_user = defaultdict(list)
    for user, ms, event_id in events:
        if user is not None and ms is not None:
            by_user[user].append((ms, event_id))
    result = {}
    for user, rows in by_user.items():
        rows.sort()
        forced = {ms for ms, event_id in rows if event_id in boundary}
        island, number, last, start, anchor = 0, 0, None, None, None
        placed = []
        for ms, event_id in rows:
            opens = last is None or ms - last > gap_ms or (ms in forced and ms != last)
            if opens:
                island, start = island + 1, ms
            if opens or ms - anchor > cap_ms:
                number, anchor = number + 1, ms
            last = ms
            if policy == "bin":
                key = f"{island}_{(ms - start) // cap_ms}"
            elif policy == "greedy":
                key = str(number)
            else:
                key = str(island)
            placed.append((key, ms, event_id))
        times = defaultdict(list)
        for key, ms, _ in placed:
            times[key].append(ms)
        for key, _, event_id in placed:
            low, high = min(times[key]), max(times[key])
            if policy == "truncate":
                high = min(high, low + cap_ms)
            result[event_id] = (f"{user}_session_{key}", low, high)
    return result
