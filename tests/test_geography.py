"""Names in texts against a plain search, and what the rules say about places."""

import re

import pytest

from marlstone.operators import gazetteer, geography as G


def plain_names(text, phrases):
    words = [(m.group().lower(), m.start(), m.end()) for m in re.finditer(r"[^\W_]+", text)]
    listed = {tuple(w.lower() for w in re.findall(r"[^\W_]+", p)): n for p, n in phrases}
    out, i = [], 0
    while i < len(words):
        fits = [k for k in range(min(5, len(words) - i), 0, -1) if tuple(w for w, _, _ in words[i : i + k]) in listed]
        if fits:
            out.append((words[i][1], words[i + fits[0] - 1][2], listed[tuple(w for w, _, _ in words[i : i + fits[0]])]))
            i += fits[0]
        else:
            i += 1
    return out


@pytest.mark.parametrize("sent", [100_000, 0])
def test_longest_names_first(spark, monkeypatch, sent):
    monkeypatch.setattr(gazetteer, "MOST_SENT", sent)
    phrases = [("new", "n"), ("new south wales", "nsw"), ("south wales", "sw"), ("Wales", "w"), ("a b", "ab"), ("b c d", "bcd"), ("ü é", "ue"), ("...", "none")]
    texts = ["New  South-Wales and south Wales", "new south", "a b c d", "xb c d, b c d!", "«Ü» é; wales", "", None, "swales new", "b c b c d " * 3000]
    rows = spark.createDataFrame(list(enumerate(texts)), "text_id int, text string")
    got = gazetteer.found_names(rows, spark.createDataFrame(phrases, "phrase string, name string")).collect()
    want = [(k, *hit) for k, t in enumerate(texts) if t for hit in plain_names(t, phrases)]
    assert sorted(map(tuple, got)) == sorted(want)
    assert gazetteer.found_names(rows, spark.createDataFrame([], "phrase string, name string")).count() == 0


def test_rules(spark):
    texts = [
        (1, "The study area lies in Ukraine near Kherson, at 46°38'N, 32°36'E, on the Dnipro River basin.", ""),
        (2, "Ismail et al. modelled the Zambezi River. Polish and German data, 48.5 N, -2.25 W.", "about Zambezi"),
        (3, "We simulate the Sava and the Lower Krka.", "the sava floods; this"),
        (4, "A global scale product on Google Earth Engine with hundreds of scenes.", None),
        (5, None, None), (6, "", ""), (7, "Cagayan River basin is the research area; 95.5, 20.1", ""),
    ]
    df = spark.createDataFrame(texts, "text_id int, text string, core string")
    got = {r.text_id: r.asDict() for r in G.geography(df).collect()}
    assert (got[1]["primary_country"], got[1]["regions"], got[1]["rivers"], got[1]["n_coordinates"], got[1]["confidence"]) == ("Ukraine", "Kherson", "Dnipro", 1, 0.9)
    assert (got[2]["countries"], got[2]["rivers"], got[2]["confidence"]) == ("Poland,Germany", "", 0.55)
    assert (got[3]["rivers"], got[3]["primary_country"], got[3]["regions"]) == ("Sava", "Slovenia/Croatia", "Lower Krka")
    assert got[4]["scope"] == "global,multi_site,global_satellite_archive" and got[5]["scope"] == got[6]["scope"] == "unknown" and got[5]["confidence"] == 0
    assert (got[7]["rivers"], got[7]["primary_country"], got[7]["n_coordinates"]) == ("Cagayan River", "Philippines", 0)
    assert {(r.text_id, r.name, r.score, r.source) for r in G.rivers(df).collect()} >= {(2, "Zambezi", 0.0, "citation"), (3, "Sava", 0.5, "unknown"), (3, "Krka", 0.0, "unknown")}
    assert sorted(map(tuple, G.coordinates(df.filter("text_id < 3")).collect())) == [(1, "degrees", 46 + 38 / 60, 32.6), (2, "decimal", 48.5, 2.25)]
