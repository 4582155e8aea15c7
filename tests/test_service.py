"""A service on this machine: how often it is asked, how fast, and what is asked again."""

import json
import threading
import time
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from fieldglass.sources import service


@pytest.fixture
def served():
    """(address, seen, answers): seen has (time, path) of each request; answers a list of statuses by path, for its first requests."""
    seen, answers, lock = [], {}, threading.Lock()

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            with lock:
                seen.append((time.monotonic(), self.path))
                status = answers[self.path].pop(0) if answers.get(self.path) else 200
            body = json.dumps({"pages": 7, "rows": [{"a": int(self.path.rsplit("/", 1)[-1] or 0), "key": self.headers.get("x-key")}]}).encode()
            self.send_response(status)
            if status == 429:
                self.send_header("Retry-After", "1")
            self.end_headers()
            self.wfile.write(body if status == 200 else b"")

        def log_message(self, *args):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_address[1]}", seen, answers
    server.shutdown()


def requests(spark, address, paths):
    return spark.createDataFrame([(f"{address}/{p}" if p is not None else None,) for p in paths], "request string")


@pytest.mark.parametrize("lanes", [1, 3])
def test_pace_holds_over_all_lanes(spark, served, lanes):
    address, seen, _ = served
    got = service.fetch(requests(spark, address, [*range(8), 3, None]), pace=0.4, lanes=lanes).collect()
    assert len(got) == 8 and all(r["error"] is None and json.loads(r["text"])["rows"][0]["a"] == int(r["request"][-1]) for r in got)
    times = sorted(t for t, _ in seen)
    assert len(times) == 8 and times[-1] - times[0] >= 0.4 * (8 - 1 - 2 * (lanes > 1) * lanes)
    if lanes == 1:
        assert min(b - a for a, b in zip(times, times[1:], strict=False)) >= 0.39


def test_tries_again_with_growing_waits(spark, served):
    address, seen, answers = served
    answers |= {"/1": [503, 503, 503], "/2": [404], "/3": [429], "/4": [500] * 9}
    got = {r["request"][-1]: r for r in service.fetch(requests(spark, address, [1, 2, 3, 4]), pace=0, tries=4, wait=0.2, headers={"x-key": "k"}).collect()}
    assert json.loads(got["1"]["text"])["rows"][0]["key"] == "k" and got["3"]["text"]
    assert got["2"]["error"] == "HTTP 404" and got["4"]["error"] == "HTTP 500" and got["4"]["text"] is None
    times = lambda p: [t for t, path in seen if path == p]
    assert [len(times(f"/{i}")) for i in (1, 2, 3, 4)] == [4, 1, 2, 4]
    a, b, c, d = times("/1")
    assert b - a >= 0.19 and c - b >= 0.39 and d - c >= 0.79 and times("/3")[1] - times("/3")[0] >= 1


def test_nothing_is_asked_twice(spark, served, tmp_path):
    address, seen, answers = served
    folder, read = str(tmp_path / "cache"), lambda: sorted(r["a"] for r in service.read_paged(spark, f"{address}/{{page}}", folder, "a int", "rows", pace=0, tries=1, at_once=2).collect())
    answers["/5"] = [500]
    with pytest.raises(OSError, match="HTTP 500"):
        read()
    assert sorted(p for _, p in seen) == [f"/{i}" for i in range(1, 8)]  # the others are in the cache
    seen.clear()
    assert read() == list(range(1, 8)) and [p for _, p in seen] == ["/5"]
    seen.clear()
    assert read() == list(range(1, 8)) and not seen
    old = service.read_cache(spark, folder).withColumn("fetched_at", F.expr("fetched_at - interval 40 days"))
    other = str(tmp_path / "old")
    old.write.parquet(other)
    assert service.read_cache(spark, other, 30).count() == 0 and service.read_cache(spark, other).count() == 7
    service.fetch_cached(requests(spark, address, [1]), other, days=30, pace=0)
    assert [p for _, p in seen] == ["/1"] and service.read_cache(spark, other, 30).count() == 1


def test_shapes(spark):
    game = '{"response": [{"fixture": {"id": 1, "date": "d", "status": {"short": "PEN"}}, "league": {"round": "Group Stage - 1"}, "teams": {"home": {"id": 5, "name": "A", "winner": false}, "away": {"id": 6, "name": "B", "winner": true}}, "goals": {"home": 1, "away": 1}, "score": {"penalty": {"home": 3, "away": 4}}}, {"fixture": {"id": 2, "status": {}}, "teams": {"home": {"name": "A", "winner": null}, "away": {"name": "C"}}, "goals": {"home": null, "away": null}, "score": {"penalty": {"home": null, "away": null}}}]}'
    line = lambda name, group: {"rank": 1, "team": {"id": 1, "name": name}, "points": 3, "goalsDiff": 2, "group": group, "all": {"played": 1, "win": 1, "draw": 0, "lose": 0, "goals": {"for": 2, "against": 0}}}
    table = json.dumps({"response": [{"league": {"standings": [[line("A", "Group K"), line("B", "Group K")], [line("A", "Group Stage")]]}}]})
    text = lambda *t: spark.createDataFrame([(x,) for x in t], "text string")
    lines = service.standings(text(table, '{"response": []}', "no json"))
    assert sorted((r["group"], r["team"], r["goals_for"]) for r in lines.collect()) == [("K", "A", 2), ("K", "B", 2)]
    got = service.with_groups(service.games(text(game)), lines).orderBy("id").collect()
    assert [(r["id"], r["winner"], r["home_penalty"], r["away_penalty"], r["group"], r["status"]) for r in got] == [(1, "away", 3, 4, "K", "PEN"), (2, None, None, None, None, None)]
    stats = text('{"response": [{"team": {"name": "A"}, "statistics": [{"type": "Fouls", "value": 12}, {"type": "Red Cards", "value": null}, {"type": "Shots", "value": "7%"}]}]}')
    assert [tuple(r) for r in service.game_statistics(stats, F.lit(9), {"fouls": "Fouls", "red": "Red Cards", "none": "None"}).collect()] == [(9, "A", 12, 0, 0)]
