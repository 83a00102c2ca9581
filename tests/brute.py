"""The analyses restated in plain Python over lists of row dicts, by definition and slowly."""

from collections import Counter, defaultdict
from datetime import timedelta

LOW = float("-inf")


def down(value):
    """Sort key for descending order with nulls last."""
    return (value is None, 0 if value is None else -value)


def day_down(date):
    return down(date.toordinal() if date else None)


def text_up(value):
    """Sort key for ascending order with nulls last."""
    return (value is None, value or "")


def top_trending(rows, limit):
    total = Counter(r["video_id"] for r in rows if r["date"])
    latest = {}
    for video in {r["video_id"] for r in rows}:
        latest[video] = min(
            (r for r in rows if r["video_id"] == video),
            key=lambda r: (day_down(r["date"]), down(r["views"]), down(r["likes"]), down(r["dislikes"])),
        )
    versions = {(r["video_id"], r["title"], r["description"]) for r in rows}
    out = [
        (*v, latest[v[0]]["views"], latest[v[0]]["likes"], latest[v[0]]["dislikes"], total[v[0]])
        for v in versions
    ]
    return sorted(out, key=lambda r: (-r[6], r[0], r[1], r[2]))[:limit]


def week_categories(rows):
    groups = defaultdict(list)
    for r in rows:
        if r["date"]:
            start = r["date"] - timedelta(days=r["date"].weekday())
            groups[start, r["video_id"], r["category_id"]].append(r["views"])
    totals = defaultdict(lambda: [0, 0])
    for (start, _, category), views in groups.items():
        if len(views) >= 2:
            totals[start, category][0] += 1
            totals[start, category][1] += max(views) - min(views)
    best = {}
    for (start, category), (n, gain) in totals.items():
        best[start] = min(best.get(start, (1, text_up(None), None)), (-gain, text_up(category), n))
    return {(start, key[1], n, -gain) for start, (gain, key, n) in best.items()}


def tags(rows, dedupe, n=10):
    seen = defaultdict(set)
    for r in rows:
        if r["date"] and r["tags"] is not None:
            for tag in r["tags"].replace('"', "").split("|"):
                for i in range(30):
                    end = r["date"] + timedelta(days=i)
                    mark = r["date"] if dedupe == "day" else None
                    seen[end, tag].add((r["video_id"], mark))
    by_end = defaultdict(list)
    for (end, tag), marks in seen.items():
        by_end[end].append((-len(marks), tag))
    return {
        (end - timedelta(days=30), end, i + 1, tag, -count)
        for end, ranked in by_end.items()
        for i, (count, tag) in enumerate(sorted(ranked)[:n])
    }


def channels(rows, limit):
    best = {}
    for r in rows:
        key = (r["channel_title"], r["video_id"])
        rank = (down(r["views"]), day_down(r["date"]))
        if key not in best or rank < best[key][0]:
            best[key] = (rank, r)
    grouped = defaultdict(list)
    for (channel, _), (_, r) in best.items():
        grouped[channel].append(r)
    out = [
        (c, min(r["date"] for r in kept), max(r["date"] for r in kept), sum(r["views"] for r in kept), len(kept))
        for c, kept in grouped.items()
    ]
    return sorted(out, key=lambda r: (-r[3], r[0]))[:limit]


def trending_channels(rows, limit):
    days = Counter(r["video_id"] for r in rows)
    pairs = {(r["video_id"], r["channel_title"]) for r in rows}
    totals = Counter()
    for video, channel in pairs:
        totals[channel] += days[video]
    return sorted(totals.items(), key=lambda r: (-r[1], r[0]))[:limit]


def category_videos(rows, n=10):
    def quotient(r):
        return r["likes"] / r["dislikes"] if r["dislikes"] else None

    best = {}
    for r in rows:
        if r["views"] > 100000:
            rank = (down(quotient(r)), -r["views"], r["category_id"], r["title"])
            if r["video_id"] not in best or rank < best[r["video_id"]][0]:
                best[r["video_id"]] = (rank, r)
    groups = defaultdict(list)
    for _, r in best.values():
        groups[r["category_id"]].append(r)
    return {
        (category, i + 1, r["video_id"], r["title"], quotient(r), r["views"])
        for category, kept in groups.items()
        for i, r in enumerate(sorted(kept, key=lambda r: (down(quotient(r)), r["video_id"]))[:n])
    }
