"""Pages as a hosting service would give them, for the paged source."""

PAGES = {
    None: ([{"id": 1, "number": 1, "created_at": "2024-01-01T00:00:00Z", "body": "a"}, {"id": 2, "number": 2, "created_at": "2024-01-02T00:00:00Z", "body": "b"}], "p2"),
    "p2": ([{"id": 2, "number": 2, "created_at": "2024-01-02T00:00:00Z", "body": "edited"}, {"id": 3, "number": 3, "created_at": "2024-01-03T00:00:00Z", "body": "c"}], None),
}


def fetch(cursor, params):
    """A service that honours `since`: a later window holds what was created then or after."""
    if params.get("since") and not cursor:
        return [x for items, _ in PAGES.values() for x in items if x["created_at"] >= params["since"]], None
    return PAGES[cursor]


def many(repo, channel):
    """Repositories by name: 'rN' has N pages of three items, 'quota' stops after one page, 'gone' is refused."""
    from loomstone.sources.hosting import AccessError, QuotaReached

    n = int(repo[1:]) if repo[1:].isdigit() else 3
    item = lambda k: {"id": k, "number": k, "created_at": f"2024-01-{k // 3 + 1:02d}T00:00:00Z", "body": f"{repo} {channel} {k}"}

    def fetch(cursor, params):
        page = int(cursor or 1)
        if repo == "gone":
            raise AccessError("404")
        if repo == "quota" and page == 2:
            raise QuotaReached(1000)
        if params.get("since") and not cursor:  # a window: what was made then or later, in one page
            return [item(k) for k in range(3 * n) if item(k)["created_at"] >= params["since"]], None
        return [item(k) for k in range(3 * page - 3, 3 * page)], str(page + 1) if page < n else None

    return fetch
