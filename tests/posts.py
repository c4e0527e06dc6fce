"""Small nested posts for the tests."""

import gzip
import json
import os


def user(uid, followers=None, friends=None, statuses=None, **kw):
    followers = 5 + uid * 7 % 50 if followers is None else followers
    friends = 5 + uid * 11 % 50 if friends is None else friends
    statuses = 5 + uid * 13 % 50 if statuses is None else statuses
    return {"id": uid, "name": f"n{uid}", "screen_name": f"u{uid}", "created_at": "Wed Oct 10 20:19:24 +0000 2018",
            "description": "d", "verified": False, "followers_count": followers, "friends_count": friends,
            "favourites_count": 1, "statuses_count": statuses, "location": "", **kw}


def post(pid, uid=1, text=None, **kw):
    out = {"id": pid, "created_at": "Thu Apr 02 10:00:00 +0000 2020", "text": text or f"text {pid}", "truncated": False,
           "in_reply_to_status_id": None, "quote_count": 0, "reply_count": 0, "retweet_count": 1, "favorite_count": 2,
           "user": user(uid), "entities": {"hashtags": [{"text": "x"}]}}
    out.update(kw)
    return out


POINT = {"type": "Point", "coordinates": [1.5, 2.5]}
PLACE = {"id": "p", "full_name": "Here", "country_code": "US"}


def write_nested(path, *batches):
    """Each batch is one line: a JSON array of JSON texts."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with gzip.open(path, "wt", encoding="utf8") as f:
        for batch in batches:
            f.write(json.dumps([json.dumps(p) for p in batch]) + "\n")


def write_array(path, posts):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with gzip.open(path, "wt", encoding="utf8") as f:
        json.dump(posts, f)


def write_lines(path, posts):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf8") as f:
        for p in posts:
            f.write(json.dumps(p) + "\n")
