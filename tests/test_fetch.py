"""Retry policy of the REST list source (no network: scripted transports)."""

import json

import pytest

from lapworks.sources.rest import FetchError, FetchTimeout, Response, fetch_with_retry


def scripted(*steps):
    calls = []

    def transport(url, timeout):
        step = steps[min(len(calls), len(steps) - 1)]
        calls.append(url)
        if isinstance(step, Exception):
            raise step
        return step
    transport.calls = calls
    return transport


def ok(body):
    return Response(200, json.dumps(body))


def run(t, **kw):
    sleeps = []
    r = fetch_with_retry("u", t, sleep=sleeps.append, delay_s=5.0, **kw)
    return r, sleeps


def test_list_first_try():
    r, sleeps = run(scripted(ok([{"a": 1}])))
    assert (r.outcome, r.attempts, json.loads(r.payload)) == ("ok", 1, [{"a": 1}]) and sleeps == []


def test_empty_list_is_success():
    r, _ = run(scripted(ok([])))
    assert r.outcome == "ok" and json.loads(r.payload) == []


def test_timeout_then_list():
    r, sleeps = run(scripted(FetchTimeout("t"), ok([1])))
    assert (r.outcome, r.attempts) == ("ok", 2) and sleeps == [5.0]


def test_timeouts_exhaust():
    r, sleeps = run(scripted(FetchTimeout("t")))
    assert (r.outcome, r.attempts, r.payload) == ("exhausted", 3, None) and sleeps == [5.0, 5.0]


def test_request_error_then_list():
    r, _ = run(scripted(FetchError("boom"), ok([1])))
    assert (r.outcome, r.attempts) == ("ok", 2)


@pytest.mark.parametrize("status", [400, 401, 403, 404])
def test_client_errors_stop_at_once(status):
    t = scripted(Response(status, None), ok([1]))
    r, sleeps = run(t)
    assert (r.outcome, r.attempts, r.status) == ("client_error", 1, status)
    assert len(t.calls) == 1 and sleeps == []


@pytest.mark.parametrize("status", [429, 500, 503])
def test_retryable_statuses(status):
    r, _ = run(scripted(Response(status, None), ok([1])))
    assert (r.outcome, r.attempts) == ("ok", 2)


def test_5xx_exhausts():
    r, sleeps = run(scripted(Response(503, None)))
    assert (r.outcome, r.attempts, r.status) == ("exhausted", 3, 503) and len(sleeps) == 2


def test_object_body_fails_without_retry():
    t = scripted(ok({"error": "x"}), ok([1]))
    r, _ = run(t)
    assert (r.outcome, r.attempts) == ("bad_format", 1) and len(t.calls) == 1


def test_undecodable_body_retries():
    r, _ = run(scripted(Response(200, "not json"), ok([2])))
    assert (r.outcome, r.attempts) == ("ok", 2)


def test_cut_off_and_garbled_bodies_are_tried_again(monkeypatch):
    import http.client
    import urllib.request

    from lapworks.sources import rest

    class Body:
        status = 200

        def __init__(self, step):
            self.step = step

        def __enter__(self):
            return self

        def __exit__(self, *a):
            return False

        def read(self):
            if isinstance(self.step, Exception):
                raise self.step
            return self.step
    for first in (http.client.IncompleteRead(b"["), b"\xff\xfe[", http.client.BadStatusLine("x")):
        steps = [first, b"[4]"]
        monkeypatch.setattr(urllib.request, "urlopen", lambda url, timeout: Body(steps.pop(0)))
        r, sleeps = run(lambda url, t: rest.http_transport("https://host/x", t))
        assert (r.outcome, r.attempts, json.loads(r.payload), sleeps) == ("ok", 2, [4], [5.0])


def test_errors_of_any_transport_are_tried_again():
    import http.client
    bad = UnicodeDecodeError("utf-8", b"x", 0, 1, "bad")
    r, _ = run(scripted(http.client.IncompleteRead(b""), bad, ok([1])))
    assert (r.outcome, r.attempts) == ("ok", 3)


def test_only_http_is_requested(tmp_path):
    from lapworks.sources.rest import http_transport
    p = tmp_path / "page.json"
    p.write_text("[3]")
    r, _ = run(lambda url, t: http_transport(f"file://{p}", t))
    assert (r.outcome, r.attempts) == ("client_error", 1)


def test_answers_are_handed_on_before_they_fill_the_memory(monkeypatch):
    """One batch of 400 URLs with 20,000 characters each: results come in parts, while it is read."""
    import pyarrow as pa

    from lapworks.sources import rest
    monkeypatch.setattr(rest, "ANSWER_CHARS", 200_000)
    asked, body = [], json.dumps(["x" * 20_000])
    urls = [f"u{i}" for i in range(400)] + [None]

    def ask(url):
        asked.append(url)
        return rest.FetchResult(url, 200 if url else None, 1, "ok", body if url else None)
    parts = rest.answers([pa.record_batch({"url": pa.array(urls, pa.string())})], ask)
    first = next(parts)
    assert first.num_rows == len(asked) == 10
    rows = [r for p in [first, *parts] for r in p.to_pylist()]
    assert [r["url"] for r in rows] == urls == asked
    assert rows[0] == {"url": "u0", "status": 200, "attempts": 1, "outcome": "ok", "payload": body}
    assert list(rows[-1].values()) == [None, None, 1, "ok", None]


def test_scripted_server_keeps_one_url():
    import pickle

    from lapworks.plans.suite import Answers
    server = Answers()
    urls = [f"https://host/events?page={i}&answers=503,timeout,ok&body=W10=&pad={'x' * 1000}" for i in range(50)]
    got = [fetch_with_retry(u, server, delay_s=0.0) for u in urls]
    assert [(r.outcome, r.attempts) for r in got] == [("ok", 3)] * 50
    assert len(pickle.dumps(server)) < 3 * len(urls[0])
