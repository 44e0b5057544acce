import hashlib
import re
import zlib

import pytest
from hypothesis import given, settings, strategies as st

from rollweave.llm import decontaminate as dc, licenses, media, pii, queries, url_filter

from .conftest import make_docs

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
lowered = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


# Ogg


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=3000) | st.integers(0, 300_000).map(lambda n: bytes(k * 7 % 251 for k in range(n))))
def test_ogg_round_trip(data):
    padded = media.pad(data)
    assert len(padded) % 192 == 0 and padded and padded.startswith(data) and len(padded) - len(data) <= 192
    back, feature = media.decode(media.encode(padded))
    assert back == padded and feature.startswith("streams=2;")


def test_ogg_damage_is_found():
    file = media.encode(media.pad(b"some text " * 500))
    for at in (0, 30, len(file) // 2, len(file) - 1):
        with pytest.raises(ValueError):
            media.decode(file[:at] + bytes([file[at] ^ 1]) + file[at + 1 :])
    with pytest.raises(ValueError):
        media.decode(file[:-5])


def test_ogg_crc_is_the_formats():
    def slow(data):
        crc = 0
        for b in data:
            crc ^= b << 24
            for _ in range(8):
                crc = (crc << 1 ^ (0x04C11DB7 if crc & 0x80000000 else 0)) & 0xFFFFFFFF
        return crc

    for data in (b"", b"\0", b"OggS", bytes(range(256))):
        assert media.page_crc(data) == slow(data)


def test_ogg_lacing_and_times():
    s = media._Stream(9)
    packets = [b"", b"x" * 255, b"y" * 70_000, b"z" * 254, b"w" * 510]
    file = b"".join([*(p for k, x in enumerate(packets) for p in s.add(x, k + 1)), s.page(media.LAST)])
    streams, n = media.demultiplex(file)
    assert [p for p, _ in streams[9]] == packets and n == 2 and streams[9][-1][1] == 5
    sound = [(b"a" * 10, media.NO_GRANULE), (b"b" * 10, 20), (b"c" * 4, 24)]
    assert media.timestamps(sound, 8) == [(0, 0.0), (10, 1.25), (20, 2.5)]


def test_ogg_query_edges(edge_docs, edge_rows, no_docs):
    rows = media.ogg_features(edge_docs, keep_media=True).collect()
    assert sorted((str(r["doc_id"]), r["n_bytes"]) for r in rows) == sorted((str(k), len((t or "").encode())) for k, t in edge_rows)
    by_text = {}
    texts = {}
    for k, t in edge_rows:
        texts.setdefault(len((t or "").encode()), set()).add(media.pad((t or "").encode()))
    for r in rows:
        payload, feature = media.decode(bytes(r["media"]))
        assert payload in texts[r["n_bytes"]] and feature == r["feature"] and r["payload_bytes"] == len(payload) == -(-max(1, r["n_bytes"]) // 192) * 192
        assert r["payload_sha256"] == hashlib.sha256(payload).hexdigest() and r["tail_crc32"] == zlib.crc32(payload[-16:])
        assert r["media_bytes"] == len(r["media"]) and r["media_sha256"] == hashlib.sha256(bytes(r["media"])).hexdigest()
        assert by_text.setdefault(payload, tuple(r)[2:]) == tuple(r)[2:]
    assert media.ogg_features(no_docs).collect() == []


def plain_ogg(file):
    """A reader of its own: packets by serial number, number of pages, granule position of the last page by serial number. Checksums bit by bit."""
    packets, open_, last, at, n = {}, {}, {}, 0, 0
    while at < len(file):
        assert file[at : at + 5] == b"OggS\0"
        granule, serial = int.from_bytes(file[at + 6 : at + 14], "little", signed=True), int.from_bytes(file[at + 14 : at + 18], "little")
        table = file[at + 27 : at + 27 + file[at + 26]]
        end = at + 27 + len(table) + sum(table)
        crc = 0
        for b in file[at : at + 22] + bytes(4) + file[at + 26 : end]:
            crc ^= b << 24
            for _ in range(8):
                crc = (crc << 1) ^ 0x104C11DB7 if crc >> 31 else crc << 1
        assert crc == int.from_bytes(file[at + 22 : at + 26], "little")
        at += 27 + len(table)
        for size in table:
            open_[serial] = open_.get(serial, b"") + file[at : at + size]
            at += size
            if size < 255:
                packets.setdefault(serial, []).append(open_.pop(serial))
        last[serial] = granule if granule >= 0 else last.get(serial)
        n += 1
    return packets, n, last


def test_stored_files_by_a_plain_reader(spark, edge_rows):
    texts = [t for _, t in edge_rows if len(t or "") < 4000] + ["é" * 5000]
    for r in media.ogg_features(make_docs(spark, list(enumerate(texts))), keep_media=True).collect():
        data = (texts[r["doc_id"]] or "").encode()
        data += b" " * (-len(data) % 192 or (0 if data else 192))
        packets, n_pages, last = plain_ogg(bytes(r["media"]))
        sound = next(s for s, p in packets.items() if p[0].startswith(b"\x01pcm8"))
        assert b"".join(packets[sound][1:]) == data and last[sound] == len(data)
        crossings = sum((a < 128) != (b < 128) for a, b in zip(data, data[1:]))
        want = f"streams=2;pages={n_pages};packets={sum(map(len, packets.values()))};seconds={len(data) / 8000:.4f};last={(len(data) - 1) // 1000 * 1000 / 8000:.4f};mean={sum(data) / len(data):.4f};peak={max(data)};crossings={crossings}"
        assert r["feature"] == want and r["media_sha256"] == hashlib.sha256(bytes(r["media"])).hexdigest() and r["payload_sha256"] == hashlib.sha256(data).hexdigest()


def test_files_from_anywhere(spark):
    """Damaged, cut, foreign, empty and chained files: an error column, and what is sound is read."""

    def file(serial, packets, granules):
        s = media._Stream(serial)
        out = []
        for p, g in zip(packets, granules, strict=True):
            out += [*s.add(p, g), s.page()]
        return out

    opus = b"OpusHead\x01\x02" + (312).to_bytes(2, "little") + bytes(7)
    flac = b"\x7fFLAC\x01\0\0\x01fLaC" + bytes(4) + bytes(10) + (44100 << 4).to_bytes(3, "big") + bytes(5)
    body = [b"a" * 70_000, b"b" * 300, b"c" * 10]
    sound = file(7, [opus, *body], [0, 48312, 96312, 144312])
    other = file(9, [flac, b"xyz"], [0, 44100])
    whole = b"".join(sound + other)
    cases = {
        0: whole,
        1: b"".join(sound[:2] + sound[3:] + other),  # a page in the middle of the long packet
        2: whole[:40] + b"\xff" + whole[41:],  # damage in the first page
        3: b"junk" + whole[:-5],
        4: b"not an Ogg file",
        5: b"",
        6: None,
        7: b"OggS",
    }
    files = spark.createDataFrame([(k, None if v is None else bytearray(v), "x") for k, v in cases.items()], "id smallint, media binary, error string")
    rows = media.ogg_streams(files, key="id").collect()
    got = {}
    for r in rows:
        got.setdefault(r["id"], {})[r["serial"]] = r
    a = got[0][7]
    assert (a["codec"], a["n_packets"], a["n_bytes"], a["n_lost"], a["first_seconds"], a["last_seconds"]) == ("opus", 4, 70_310 + len(opus), 0, 0.0, 3.0)
    assert a["packets_sha256"] == hashlib.sha256(opus + b"".join(body)).hexdigest() and a["error"] == "the stream doesn't end"
    assert (got[0][9]["codec"], got[0][9]["last_seconds"]) == ("flac", 1.0)
    assert got[1][7]["n_lost"] == 1 and got[1][7]["n_packets"] == 3 and "missing" in got[1][7]["error"] and got[1][9]["n_lost"] == 0
    assert got[2][7]["codec"] is None and "checksum" in got[2][7]["error"] and got[2][9]["codec"] == "flac"
    assert got[3][7]["n_packets"] == 4 and "no page at 0" in got[3][7]["error"] and got[3][9]["n_packets"] == 1
    assert all(got[k][None]["error"] and got[k][None]["n_pages"] == 0 for k in (4, 5, 6, 7))
    for bad in (b"", whole):
        with pytest.raises(ValueError):
            media.decode(bad)


def test_blobs_and_keys_of_any_type(spark):
    """Binary columns are stored as they are; keys may have any plain type."""
    rows = [(1, bytearray(b"\xff\x00\xfe"), "a"), (None, None, "b")]
    for kind in ("smallint", "decimal(12,2)", "date", "string", "timestamp", "boolean"):
        docs = spark.createDataFrame(rows, "n int, text binary, error string")
        docs = docs.selectExpr(f"cast({'timestamp_seconds(n)' if kind in ('date', 'timestamp') else 'n'} as {kind}) as doc_id", "text", "error")
        out = media.ogg_features(docs, keep_media=True)
        assert dict(out.dtypes)["doc_id"] == kind
        by = {r["doc_id"] is None: r for r in out.collect()}
        assert by[False]["n_bytes"] == 3 and media.decode(bytes(by[False]["media"]))[0] == b"\xff\x00\xfe" + b" " * 189 and by[True]["n_bytes"] == 0


# URLs


def test_split_url():
    assert url_filter.split_url("HTTP://Ex.ORG/A?b#c") == ("ex.org", "/A")
    assert url_filter.split_url("a://b#/c") == ("b", "")
    assert [url_filter.split_url(x) for x in (None, "", "www.x.org/a")] == [("", "")] * 3


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab*?^/", min_size=1, max_size=12), min_size=1, max_size=30), st.lists(st.text("ab/é☃", max_size=12), min_size=1, max_size=6))
def test_automaton_matches_regex(globs, texts):
    rules = [re.compile("".join({"*": ".*", "?": ".", "^": "[^/]*"}.get(c, re.escape(c)) for c in g), re.S) for g in globs]
    assert url_filter.Automaton.of(globs).match(texts).tolist() == [[bool(r.fullmatch(t)) for r in rules] for t in texts]


def test_url_rules(spark):
    cases = {
        "https://a.org/x": ("org/", "allow"),
        "https://example.org/en/12?q": ("example.org/en/1", "block"),
        "https://m.example.org/es/1": ("example.org/es/", "block"),
        "https://badexample.org/es/1": ("org/", "allow"),
        "https://org": (None, "allow"),
        "https://x.com/fr/1": ("com/fr/", "allow"),
        "https://x.com/de/1": ("com/de/", "block"),
        "https://spam.net/": (None, "block"),
        None: (None, "allow"),
        "": (None, "allow"),
        "https://x.net/" + "a" * 5000 + ".zip": (None, "block"),
    }
    rows = [(k, u, "h", 1) for k, u in enumerate(cases)] * 2 + [(None, "https://a.org/x", None, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host int")
    out = url_filter.url_filter(pages).collect()
    assert len(out) == len(rows)
    want = dict(enumerate(cases.values())) | {None: ("org/", "allow")}
    assert all((r["rule"], r["verdict"]) == want[r["page_id"]] for r in out)
    assert url_filter.url_filter(pages.limit(0)).collect() == []


# Decontamination


def brute_contamination(rows, items):
    windows = []
    for key, t in items:
        w = WORD.findall(lowered(t))
        n = min(13, len(w))
        windows += [(str(key), w[i : i + n]) for i in range(len(w) - n + 1)] if n else []
    out = []
    for k, t in rows:
        w = WORD.findall(lowered(t))
        hit, found = set(), set()
        places = {}
        for i, x in enumerate(w):
            places.setdefault(x, []).append(i)
        for key, g in windows:
            for i in places.get(g[0], ()):
                if w[i : i + len(g)] == g:
                    hit.update(range(i, i + len(g)))
                    found.add(key)
        out.append((k, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


@pytest.mark.parametrize("most", [500_000, 40])
def test_contamination(spark, edge_docs, edge_rows, no_docs, most):
    long_item = " ".join(edge_rows[22][1].split()[100:140])
    items = [(1, long_item), (2, "One, TWO"), (3, None), (4, "--"), (5, long_item), (10, "alpha"), (11, edge_rows[16][1][-200:]), (None, "ünïcode ☃ ünïcode")]
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    items = [("" if k is None else k, t) for k, t in items]
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    out = dc.contamination(edge_docs, bench, block_words=most).select(*columns).collect()
    assert sorted(map(tuple, out), key=str) == brute_contamination(edge_rows, items)
    clean = {(r[0], r[1]) for r in brute_contamination(edge_rows, items) if not r[-1]}
    kept = dc.decontaminate(edge_docs, bench, block_words=most)
    assert kept.columns == edge_docs.columns
    assert {(r["doc_id"], len(WORD.findall(lowered(r["text"])))) for r in kept.collect()} == clean
    assert dc.contamination(no_docs, bench, block_words=most).collect() == []
    assert dc.decontaminate(edge_docs, bench.limit(0)).count() == len(edge_rows)


@pytest.mark.parametrize("most", [500_000, 20])
def test_repeated_rows_stay_at_every_size(spark, edge_docs, edge_rows, most):
    items = [(1, " ".join(edge_rows[22][1].split()[100:140])), (2, "alpha beta gamma")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = dc.contamination(edge_docs, bench, block_words=most).collect()
    assert sorted(str(r["doc_id"]) for r in out) == sorted(str(k) for k, _ in edge_rows)


@pytest.mark.parametrize("most", [500_000, 20])
def test_remove_spans(spark, edge_docs, edge_rows, no_docs, most):
    word = lambda n, k: " ".join(f"{k}{i}" for i in range(n))
    item, short = word(45, "q"), "Zwölf, kurze Wörter"
    bench = spark.createDataFrame([(1, item), (2, short), (3, word(30, "r"))], "item_id long, text string")
    before, after = word(450, "a") + ",\n", "; " + word(450, "b")
    rows = [(0, before + item.upper() + after), (1, before + short + after), (2, short), (3, word(5, "c") + " (" + item + ")"), (4, None), (5, ""), (0, before + item.upper() + after), (None, before + "é" + after)]
    docs = make_docs(spark, rows)
    out = dc.remove_spans(docs, bench, block_words=most)
    assert out.dtypes == docs.dtypes
    want = [(0, before + after), (1, before + short + after), (2, ""), (3, word(5, "c") + " ()"), (4, None), (5, ""), (0, before + after), (None, before + "é" + after)]
    got = out.collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == sorted(want, key=str)
    assert all(r["n_chars"] == (len(r["text"]) if r["text"] is not None else None) for r in got)
    left = dc.contamination(out, bench, block_words=most).where("doc_id != 1").collect()
    assert all(r["n_hit"] == 0 for r in left)
    assert dc.remove_spans(no_docs, bench, block_words=most).collect() == []


def test_sieves_miss_nothing(spark, edge_docs, edge_rows, monkeypatch):
    text = edge_rows[22][1].split()
    items = [(k, " ".join(text[at : at + n])) for k, (at, n) in enumerate([(0, 40), (7, 5), (30, 13), (100, 90), (3, 1)])] + [(9, "ünïcode ☃ ünïcode"), (10, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(dc._hits, "__defaults__", (30,))
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert len(list(dc.sieves(bench, "text", 13, 30))) > 2
    out = dc.contamination(edge_docs, bench, block_words=20).select(*columns).collect()
    assert sorted(map(tuple, out), key=str) == brute_contamination(edge_rows, [x for x in items if x[1]])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("abc", max_size=12), min_size=1, max_size=5), st.text("abcd", max_size=40), st.integers(1, 5))
def test_sieve_holds_what_the_automaton_finds(items, text, window):
    split = lambda t: [c.encode() for c in t]
    grams = {}
    for t in items:
        if n := min(window, len(t)):
            grams.setdefault(n, []).append(dc.gram_hashes(split(t), n))
    found = dc.SuffixAutomaton([(str(k), split(t)) for k, t in enumerate(items)], window).scan(split(text))[1]
    assert dc.Sieve(grams).holds(split(text)) == bool(found)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("abc", max_size=12), min_size=1, max_size=5), st.text("abcd", max_size=40), st.integers(1, 5))
def test_automaton_finds_all_windows(items, text, window):
    got = dc.SuffixAutomaton([(str(k), [c.encode() for c in t]) for k, t in enumerate(items)], window).scan([c.encode() for c in text])
    hit, found = set(), set()
    for k, t in enumerate(items):
        n = min(window, len(t))
        for i in range(len(t) - n + 1) if n else ():
            for j in range(len(text) - n + 1):
                if text[j : j + n] == t[i : i + n]:
                    hit.update(range(j, j + n))
                    found.add(str(k))
    assert {p for a, b in got[0] for p in range(a, b)} == hit and got[1] == found


def test_automaton_is_bounded_by_its_words():
    """The bytes that a worker holds for each word of a block, as the docstring says."""
    import pickle
    import random
    import tracemalloc

    draw = random.Random(1)
    items = [(str(k), [b"w%d" % draw.randrange(20_000) for _ in range(50)]) for k in range(400)]
    sent = pickle.dumps(dc.SuffixAutomaton(items))
    tracemalloc.start()
    held = pickle.loads(sent)
    size = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held.scan(items[7][1])[1] == {"7"} and size <= dc.BYTES_A_WORD * 400 * 50


# Licenses


def test_license_base(edge_docs, edge_rows, no_docs):
    phrases = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

    def brute(t):
        w = WORD.findall(lowered(t))
        at = [(i, label) for p, label in phrases.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        return len(w), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None), ",".join(sorted({x for _, x in at}))

    texts = ["MIT-License mit license License", "the apache\nlicense, GENERAL public license", "mit", "é mit license mit license"] + [t for _, t in edge_rows]
    automata = [licenses.TokenAutomaton(*t) for t in licenses.TEMPLATES]
    for t in texts:
        assert licenses.scan(t, licenses.PHRASES, automata)[:5] == brute(t)
    assert licenses.license_scan(edge_docs).count() == len(edge_rows) and licenses.license_scan(no_docs).collect() == []


def test_license_templates():
    run = lambda t: licenses.scan(t, licenses.PHRASES, [licenses.TokenAutomaton(*x) for x in licenses.TEMPLATES])[4:]
    assert run("x. Licensed under CC BY-NC 4.0.")[1:] == ("cc-by-nc-4.0", 1.0)
    assert run("This work is licensed under the GNU General Public License, version 3.") == ("gpl", "gpl,gpl-3.0", 1.0)
    assert run("Licensed under the Apache License, Version 2.0.") == ("apache", "apache,apache-2.0", 1.0)
    assert run("Permission is hereby granted, free of charge, to any person obtaining a copy of this software to deal in the Software without restriction")[1] == "mit"
    labels, score = run("licensed under the gnu general public")[1:]
    assert labels == "" and 0 < score < 1


@settings(max_examples=200, deadline=None)
@given(st.text("ab ", max_size=14))
def test_license_automaton_matches_regex(text):
    t = licenses.TokenAutomaton("x", "a [[b b]] {{v:1-2}} a [[b]] b")
    want = re.search(r"(?:^| )a(?: b b)?(?: \w+){1,2} a(?: b)? b(?: |$)", " ".join(text.split()))
    assert (licenses.scan(text, (), [t])[5] == "x") == bool(want)


def plain_license(text):
    """(labels, score) by a regular expression for each template, and a recursion over its words for how far a run gets."""
    tokens = WORD.findall(lowered(text))
    joined = "".join(f" {w}" for w in tokens)
    base = {label for phrase, label in licenses.PHRASES if f" {phrase} " in joined + " "}
    labels, best = set(base), 1.0 if base else 0.0
    for label, template in licenses.TEMPLATES:
        regex, ops, skips = "", [], {}
        for part in re.findall(r"\[\[.*?\]\]|\{\{.*?\}\}|[^ \[{]+", template):
            begin = len(ops)
            if part.startswith("[["):
                own = part[2:-2].split()
                regex += "(?:" + "".join(f" {w}" for w in own) + ")?"
                ops += own
                skips.setdefault(begin, []).append(len(ops))
            elif part.startswith("{{"):
                low, high = map(int, part[2:-2].split(":")[1].split("-"))
                regex += f"(?: [^ ]+){{{low},{high}}}"
                ops += [None] * high
                for k in range(low, high):
                    skips.setdefault(begin + k, []).append(begin + high)
            else:
                regex += f" {part}"
                ops.append(part)
        if re.search(f"{regex}(?= |$)", joined):
            labels.add(label)
        if max((w for w in re.sub(r"\[\[.*?\]\]|\{\{.*?\}\}", " ", template).split()), key=len) not in tokens:
            continue
        for i in range(len(tokens)):
            seen, todo = set(), [(0, i)]
            while todo:
                p, j = todo.pop()
                if (p, j) in seen:
                    continue
                seen.add((p, j))
                todo += [(q, j) for q in skips.get(p, ())]
                if p < len(ops) and j < len(tokens) and ops[p] in (None, tokens[j]):
                    todo.append((p + 1, j + 1))
            # A run that a leading gap alone lets begin anywhere only counts where the first word behind the gap stands.
            lead = next(k for k, w in enumerate(ops) if w is not None)
            if any(p > lead for p, _ in seen):
                best = max(best, max(p for p, _ in seen) / len(ops))
    return ",".join(sorted(labels)), best


def test_shipped_templates_match_plain_ones():
    import random

    draw = random.Random(4)
    automata = [licenses.TokenAutomaton(*t) for t in licenses.TEMPLATES]
    texts = []
    for _, template in licenses.TEMPLATES:
        for _ in range(8):
            out = []
            for part in re.findall(r"\[\[.*?\]\]|\{\{.*?\}\}|[^ \[{]+", template):
                if part.startswith("[["):
                    out += part[2:-2].split() if draw.random() < 0.5 else []
                elif part.startswith("{{"):
                    low, high = map(int, part[2:-2].split(":")[1].split("-"))
                    out += [draw.choice(["acme", "the", "software"]) for _ in range(draw.randint(low, high))]
                else:
                    out.append(part)
            texts += [" ".join(["Some", "text."] + out + ["follows"]), " ".join(out[: draw.randrange(len(out))]), " ".join(w for w in out if draw.random() > 0.03)]
    found = set()
    for t in texts:
        got, want = licenses.scan(t, licenses.PHRASES, automata)[5:], plain_license(t)
        assert got[0] == want[0] and abs(got[1] - want[1]) < 1e-6, t
        found.update(got[0].split(","))
    assert {label for label, _ in licenses.TEMPLATES} <= found


def test_license_scan_is_linear():
    import time

    automata = [licenses.TokenAutomaton(*t) for t in licenses.TEMPLATES]
    began = time.time()
    assert licenses.scan("mit license " * 200_000, licenses.PHRASES, automata)[1] == 200_000
    assert time.time() - began < 30


# Personal data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")


def brute_pii(t):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub(r"[^0-9]", "", m[0])
        total = sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(d[::-1]))
        if 12 <= len(d) <= 19 and total % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.findall("[0-9]", m[0])) <= 15]
    return sorted(out)


@settings(max_examples=400, deadline=None)
@given(st.text("a@.-1250 +(é", max_size=40) | st.text("0123456789 -", max_size=60) | st.text("a@.", max_size=30))
def test_pii_base(text):
    assert pii.base_spans(text) == brute_pii(text)


def test_pii_bootstrap(spark, edge_docs, edge_rows, no_docs):
    rows = [(k, f"bla bla write to u{k}@mail.example.com now and on") for k in range(5)]
    rows += [(10, "please write to agent-00712x soon"), (11, "nothing to see in 123456 here"), (12, None), (12, None), (13, "4111 1111 1111 1111 and 1.2.3.4"), (13, "no")]
    out = pii.find_pii(make_docs(spark, rows)).select("doc_id", "base", pii.joined("all").alias("spans")).collect()
    assert len(out) == len(rows)
    spans = {(r["doc_id"], r["spans"]) for r in out}
    assert (10, "id:16:28") in spans and (11, "") in spans and (12, "") in spans and (0, "email:17:36") in spans
    assert (13, "card:0:19,ip:24:31") in spans and (13, "") in spans
    assert pii.find_pii(edge_docs).count() == len(edge_rows) and pii.find_pii(no_docs).collect() == []


def brute_graph(rows, rounds=pii.ROUNDS):
    """The ``id`` spans by plain dictionaries, and identifier-like tokens found by a plain scan."""
    token = re.compile(r"[A-Za-z0-9._%+/@:-]+")
    per, edges, seeds = [], {}, set()
    for key, t in rows:
        t = t or ""
        base = brute_pii(t)
        found = [(a, b, True) for a, _, b in base]
        for m in token.finditer(t):
            whole = m[0].strip("._%+-/@:")
            a = m.start() + len(m[0]) - len(m[0].lstrip("._%+-/@:"))
            if len(whole) >= 6 and sum(c in "0123456789" for c in whole) >= 3 and not any(x < a + len(whole) and a < y for x, _, y in base):
                found.append((a, a + len(whole), False))
        own = []
        for a, b, seed in found:
            before = t[:a].lower().split()[-2:]
            if before and all(len(w) <= pii.MOST_WORD for w in before):
                pattern, instance = " ".join(before), t[a:b].lower()
                edges.setdefault(pattern, set()).add(instance)
                if seed:
                    seeds.add((pattern, instance))
                own.append((a, b, seed, pattern))
        per.append((key, own))
    trust = {}
    for _ in range(rounds):
        score = lambda p: [1.0 if (p, i) in seeds else trust.get(i, 0.0) for i in edges[p]]  # noqa: B023, E731
        good = {p: sum(x) / len(x) for p in edges if (x := score(p)) and sum(x) / len(x) >= pii.THRESHOLD and sum(v >= pii.THRESHOLD for v in x) >= pii.MIN_SEEDS}
        trust = {}
        for p, s in good.items():
            for i in edges[p]:
                trust[i] = 1 - (1 - trust.get(i, 0.0)) * (1 - min(s, 0.999))
    return {key: sorted((a, b) for a, b, seed, p in own if not seed and p in good) for key, own in per}


def test_found_identifiers_induce_patterns(spark, edge_rows):
    """Seeds vouch for agent numbers; those, found, vouch for a pattern that no seed has. Very long words and lines of digits are no trouble."""
    rows = [(k, f"bla bla write to u{k}@mail.example.com now and on") for k in range(30)]
    rows += [(40 + k, f"please write to agent-0071{k}x soon") for k in range(5)]
    rows += [(50 + k, f"the file of agent-0071{k}x is closed") for k in range(5)] + [(60, "the file of badge-99887 is closed"), (61, "another case number 123456 here")]
    rows += [(62, "z" * 5000 + " agent-00711x"), (63, "1" * 20000 + "...1.2.3.4"), (64, None), (65, " " * 3000 + "file of badge-99887,agent-00710x")]
    rows += [(100 + k, t) for k, (_, t) in enumerate(edge_rows)]
    out = {r["doc_id"]: r for r in pii.find_pii(make_docs(spark, rows)).collect()}
    want = brute_graph(rows)
    assert {k: sorted((x["s"], x["e"]) for x in r["all"] if x["k"] == 4) for k, r in out.items()} == want
    assert want[40] and want[50] and want[60] and not want[61] and not want[62]


def test_ip_scan_is_linear():
    import time

    began = time.time()
    assert pii.base_spans("1" * 400_000 + "....") == [] and pii.base_spans("1." * 200_000)[0] == (0, 1, 7)
    assert time.time() - began < 10


def test_pii_query_counts_each_kind(spark, edge_rows, tmp_path):
    """All exact columns of the query, against the contract read plainly."""
    card, phone = "4111 1111 1111 1111", "+1 (555) 010-9999"
    rows = [(100, "a@b.co"), (101, "a@b.co, c@d.eu and e@f.org"), (102, "1.2.3.4 then a@b.co"), (103, card), (104, f"é☃ {phone}; {phone}"), (105, f"{phone} {card} 1.2.3.4 a@b.co"), (105, "1.1.1.1 2.2.2.2 256.1.1.1")]
    rows += edge_rows
    make_docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for key, t in rows:
        base = brute_pii(t or "")
        digest = hashlib.sha256(",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base).encode()).hexdigest()
        want.append((key, *(sum(k == n for _, k, _ in base) for n in range(4)), digest))
    got = queries.op10_pii(spark, str(tmp_path)).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")
    assert [kind for _, kind in got.dtypes] == ["bigint"] * 5 + ["string"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
