"""APIs polled as a stream: each hour once, whatever stops and starts."""

import os

import pytest

from aerolake.sources import places, polling
from test_operators import frame

START = 1748736000  # a full hour


def log_fetcher(log, broken=None):
    """Answers and writes down each call; fails while the file ``broken`` is there."""

    def fetch(method, url, params, payload):
        with open(log, "a") as out:
            out.write(params["lat"] + "\n")
        if broken and os.path.exists(broken):
            raise RuntimeError("no connection")
        return 200, "{}"

    return fetch


@pytest.fixture()
def source(spark, folder):
    rows = [(f"p{i}", float(i), 1.5, i) for i in range(7)]
    requests = places.weather_requests(frame(spark, rows, "nome string, latitude double, longitude double, ordinal long"))
    columns = polling.land_requests(requests, f"{folder}/requests", calls_per_task=3)

    def run(at, fetcher, stop=None):
        query = polling.poll(spark, "polled_" + os.path.basename(folder), f"{folder}/requests", columns, fetcher,
                             f"{folder}/answers", f"{folder}/checkpoint", lambda: at)
        query.awaitTermination()

    def hours():
        got = spark.read.parquet(f"{folder}/answers").groupBy("polled").count().collect()
        return sorted((int(r.polled.timestamp()), r["count"]) for r in got)

    return run, hours


def calls(log):
    with open(log) as lines:
        return len(lines.readlines())


def test_an_hour_is_polled_once(source, folder):
    run, hours = source
    fetch = log_fetcher(f"{folder}/log")
    for minutes, expected in ((5, 7), (6, 7), (59, 7), (60, 14), (61, 14), (600, 21)):
        run(START + 60 * minutes, fetch)
        assert calls(f"{folder}/log") == expected
    # Hours without a start are not caught up.
    assert hours() == [(START, 7), (START + 3600, 7), (START + 36000, 7)]


def test_a_clock_that_goes_back_polls_nothing(source, folder):
    run, hours = source
    fetch = log_fetcher(f"{folder}/log")
    run(START + 7200, fetch)
    run(START, fetch)
    assert calls(f"{folder}/log") == 7 and hours() == [(START + 7200, 7)]
    run(START + 3 * 3600, fetch)
    assert hours() == [(START + 7200, 7), (START + 3 * 3600, 7)]


def test_a_lost_batch_keeps_its_hour(source, folder):
    run, hours = source
    open(f"{folder}/broken", "w").close()
    fetch = log_fetcher(f"{folder}/log", f"{folder}/broken")
    with pytest.raises(Exception, match="no connection"):
        run(START + 60, fetch)
    os.unlink(f"{folder}/broken")
    run(START + 1800, fetch)
    assert hours() == [(START, 7)]
    done = calls(f"{folder}/log")
    run(START + 2400, fetch)
    assert calls(f"{folder}/log") == done


def test_new_requests_are_polled_from_the_next_hour(spark, source, folder):
    run, hours = source
    fetch = log_fetcher(f"{folder}/log")
    run(START, fetch)
    more = frame(spark, [("q", 1.0, 2.0, 0)], "nome string, latitude double, longitude double, ordinal long")
    polling.land_requests(places.weather_requests(more), f"{folder}/requests")
    run(START + 10, fetch)
    run(START + 3600, fetch)
    assert hours() == [(START, 7), (START + 3600, 1)]


def test_no_requests(spark, folder):
    none = frame(spark, [("q", 1.0, 2.0, 0)], "nome string, latitude double, longitude double, ordinal long").limit(0)
    columns = polling.land_requests(places.weather_requests(none), f"{folder}/requests")
    polling.poll(spark, "polled_none", f"{folder}/requests", columns, log_fetcher(f"{folder}/log"), f"{folder}/answers",
                 f"{folder}/checkpoint", lambda: START).awaitTermination()
    assert not os.path.exists(f"{folder}/log")
