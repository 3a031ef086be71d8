"""Regions of pages against a plain version."""

import random

from marlstone.operators import regions as R

SCHEMA = "doc string, page int, id int, role string, text string, x0 double, y0 double, x1 double, y1 double"


def gap(a, b, k):
    return max(0.0, max(a[k], b[k]) - min(a[k + 2], b[k + 2]))


def shares(a, b, k):
    return a[k] < b[k + 2] and b[k] < a[k + 2]


def near(a, b):
    level = abs((a[1] + a[3]) / 2 - (b[1] + b[3]) / 2) < 40
    return (shares(a, b, 0) and (shares(a, b, 1) or gap(a, b, 1) <= 120)) or (level and gap(a, b, 0) <= 80)


def tight(a, b):
    return shares(a, b, 0) and (shares(a, b, 1) or gap(a, b, 1) <= 40)


def around(boxes):
    boxes = list(boxes)
    return tuple(f(b[k] for b in boxes) for k, f in enumerate((min, min, max, max)))


def grow(regions, rule):
    """{(place, family, id): (box, blocks)} merged in rounds, all that fits in a round at once."""
    while True:
        label = {k: k for k in regions}
        changed = True
        while changed:
            changed = False
            for a in regions:
                for b in regions:
                    if a[:2] == b[:2] and a != b and rule(regions[a][0], regions[b][0]) and label[a] != label[b]:
                        label[a] = label[b] = min(label[a], label[b])
                        changed = True
        if all(k == v for k, v in label.items()):
            return regions
        new = {}
        for k, v in label.items():
            new.setdefault(v, []).append(regions[k])
        regions = {k: (around(b for b, _ in v), sorted(x for _, bl in v for x in bl)) for k, v in new.items()}


def plain(rows):
    family = {"figure": "figure", "graphic": "figure", "table": "table", "table_head": "table", "formula": "formula"}
    box, role, text = {r[2]: r[5:] for r in rows}, {r[2]: r[3] for r in rows}, {r[2]: r[4] for r in rows}
    first = grow({((r[0], r[1]), family[r[3]], r[2]): (r[5:], [r[2]]) for r in rows if r[3] in family}, near)
    held = {k: [] for k in first}
    for r in rows:
        if r[3] in family:
            continue
        best = []
        for (place, fam, i), (b, _) in first.items():
            if place != (r[0], r[1]) or (fam == "formula") != (r[3] == "context"):
                continue
            v, h = gap(b, r[5:], 1), gap(b, r[5:], 0)
            if shares(b, r[5:], 0) and shares(b, r[5:], 1):
                best.append((0.0, fam, i))
            elif (shares(b, r[5:], 0) or h <= 80) and v <= 120:
                best.append((v + h / 2, fam, i))
            elif any(w in r[4].lower() for w in R.CAPTION_WORDS) and v <= 180:
                best.append((v + h, fam, i))
        if best:
            _, fam, i = min(best)
            held[(r[0], r[1]), fam, i].append(r[2])
    wide = {k: (around([b, *(box[x] for x in held[k])]), sorted(bl + held[k])) for k, (b, bl) in first.items()}
    last = {**grow({k: v for k, v in wide.items() if k[1] != "formula"}, near), **grow({k: v for k, v in wide.items() if k[1] == "formula"}, tight)}
    out = {}
    for (place, fam, _), (b, bl) in last.items():
        said = sorted((box[x][1], box[x][0], x) for x in bl if role[x] in ("caption", "label"))
        out[place, tuple(bl)] = (fam, b, " ".join(text[x] for *_, x in said))
    return out


def test_regions_by_a_plain_version(spark):
    rng = random.Random(11)
    rows = []
    for i in range(70):
        x, y = float(rng.randrange(0, 480)), float(rng.randrange(0, 900))
        role = rng.choice(["figure", "graphic", "table", "table_head", "formula", "formula", "caption", "label", "context"])
        rows.append((rng.choice("ab"), rng.randint(1, 2), i, role, rng.choice(["Fig. 1 a map", "words"]), x, y, x + rng.choice([10, 60, 90]), y + rng.choice([5, 30, 70])))
    want = plain(rows)
    found = R.regions(spark.createDataFrame([*rows, ("a", 1, 99, "figure", "", None, 1.0, 2.0, 3.0)], SCHEMA), 600.0, 3000.0).collect()
    got = {((r.doc, r.page), tuple(r.blocks)): r for r in found}
    assert set(got) == set(want) and len({r.region_id for r in found}) == len(found)
    assert max(len(k[1]) for k in got) > 3
    for k, r in got.items():
        fam, box, caption = want[k]
        assert r.caption == caption
        assert {"formula": {"FORMULA_REGION"}, "table": {"TABLE_REGION"}}.get(fam, {"FIGURE_REGION", "CHART_REGION", "MULTI_PANEL_FIGURE", "SCIENTIFIC_DIAGRAM"}) >= {r.region_type}
        top, bottom, left, right = R.ROOM[r.region_type]
        assert (r.x0, r.y0, r.x1, r.y1) == (max(0.0, box[0] - left), max(0.0, box[1] - top), min(600.0, box[2] + right), min(3000.0, box[3] + bottom))


def test_no_blocks(spark):
    assert R.regions(spark.createDataFrame([], SCHEMA)).count() == 0
