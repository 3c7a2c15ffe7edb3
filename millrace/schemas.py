"""Declared schemas (DDL text) of every input and stored table; nothing is inferred at read time."""

from __future__ import annotations

# Ids arrive as numbers or strings; both read as strings and are cast on the way in.
ARCHIVE_EVENT = (
    "id string, type string, repo struct<id: string, name: string>, "
    "actor struct<id: string, login: string>, created_at string"
)
FLAT_EVENT = "type string, submitter string, owner string, repo string"
TYPED_EVENT = (
    "event_type string, repo string, actor_name string, owner string, repo_name string, "
    "created_at timestamp, actor_id bigint, repo_id bigint, event_id bigint"
)

TRADE = "login bigint, ticket bigint, cmd int, open_time timestamp, close_time timestamp"
TRADE_MARK = "ticket bigint, type int"
DEAL = "login bigint, positionid bigint, action int, entry int, time timestamp"
DEAL_MARK = "positionid bigint, type int"

RAW_RATE = "code string, rate string, base string, date string"
TYPED_RATE = "base string, symbol string, rate double, date date"
DAILY_RATE = (
    "base string, symbol string, min_rate double, avg_rate double, max_rate double, "
    "date date, timestamp timestamp"
)
LATEST_RATE = (
    "motd struct<msg: string, url: string>, success string, base string, date string, "
    "rates map<string, double>"
)

MOVIE = "movieId string, title string"
RATING = "userId string, movieId string, rating string, timestamp string"
