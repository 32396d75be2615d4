"""DataFrame operators: star builders, aggregates, windows, search, quality,
scoring, signals/alerts and lifecycle replays."""
