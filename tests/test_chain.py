"""The enrichment chain against a fold over records in Python."""

import copy
import random

from pyspark.sql import functions as F

from biblioforge.operators import chain
from biblioforge.schemas import BOOK_V2

FULL = lambda x: x not in (None, "")


def formats(w):
    return [f for e in w["editions"] or [] for f in e["formats"] or []]


def fold(w, sources, checked, verdicts, auto):
    w, changes, reviews = copy.deepcopy(w), [], []
    latest = next((e for e in w["editions"] or [] if e["is_latest"]), None)
    key = next((f["isbn"] for f in formats(w) if FULL(f["isbn"])), None)
    for name, by_isbn, by_title, languages in sources:
        entry = by_isbn.get(key) if key else (by_title or {}).get(w["title"])
        if entry is None or (languages and w["language"] not in languages):
            continue
        a, b = set(w["title"].lower().split()), set((entry["title"] or "").lower().split())
        reasons = []
        if FULL(entry["title"]) and len(a & b) / max(len(a), len(b)) < 0.5:
            reasons.append("TITLE_MISMATCH")
        if entry["authors"] and w["authors"] and not {x.lower() for x in entry["authors"]} & {x.lower() for x in w["authors"]}:
            reasons.append("AUTHOR_MISMATCH")
        if reasons:
            reviews.append((name, reasons))
            continue
        lf = (latest or {}).get("formats") or []
        if FULL(entry["isbn"]) and not any(FULL(f["isbn"]) for f in formats(w)) and lf:
            lf[0]["isbn"] = entry["isbn"]
            changes.append(f"isbn:{name}")
        free = next((f for f in lf if f["price"] is None), None)
        if entry["price"] and not any(f["price"] and f["price"]["amount"] for f in formats(w)) and free:
            free["price"] = entry["price"]
            changes.append(f"price:{name}")
        for field, cut in (("pages", None), ("description", 2000)):
            free = next((e for e in w["editions"] or [] if e["is_latest"] and not FULL(e[field])), None)
            if FULL(entry[field]) and not any(FULL(e[field]) for e in w["editions"] or []) and free:
                free[field] = entry[field] if cut is None else entry[field][:cut]
                changes.append(f"{field}:{name}")
        if FULL(entry["publisher"]) and (not FULL(w["publisher"]) or w["publisher"] == "Unknown"):
            w["publisher"] = entry["publisher"]
            changes.append(f"publisher:{name}")
    has_url = any(FULL(f["url"]) for f in (latest or {}).get("formats") or [])
    if not has_url or not any(f["url_status"] == "valid" for f in formats(w)):
        isbn = next((f["isbn"] for f in formats(w) if FULL(f["isbn"])), None)
        base = "https://www.amazon." + ("co.jp" if w["language"] == "ja" else "com")
        url = f"{base}/dp/{isbn}" if isbn and len(isbn) == 10 else f"{base}/s?k={isbn}" if isbn else f"{base}/s?k={w['title'].replace(' ', '+')}"
        if checked.get(url) and latest and latest["formats"]:
            latest["formats"][0] |= {"url": checked[url], "url_status": "valid", "url_verified_at": "now"}
            changes.append("url_validated" if has_url else "amazon_url:valid")
    found = bool(changes)
    if v := verdicts.get(w["work_id"]):
        reasons = ["LOW_CONFIDENCE"] * (v[2] < 0.6) + ["SEGMENT_CHANGE"] * (w["segment"] not in ("", "Other") and (w["segment"], w["subsegment"]) != v[:2])
        applied = auto and reasons == ["SEGMENT_CHANGE"] and v[2] >= 0.7
        if reasons and not applied:
            reviews.append(("classifier", reasons))
        else:
            for c, x in zip(("segment", "subsegment"), v[:2], strict=True):
                if w[c] != x:
                    changes.append(f"{c}:{x[:20]}" + "(auto)" * applied)
                    w[c] = x
    if found:
        if any(FULL(f["isbn"]) for f in formats(w)) and any(f["price"] and f["price"]["amount"] for f in formats(w)) and any(f["url_status"] == "valid" for f in formats(w)) and w["dataset_status"] != "verified":
            w["dataset_status"] = "verified"
            changes.append("status:verified")
        w["data_sources"], w["updated_at"] = [*w["data_sources"], "enriched"], "now"
    return w, changes, reviews


def test_chain(spark):
    r = random.Random(8)
    price = lambda: r.choice([None, {"amount": 5.0, "currency": "USD", "price_type": None}])
    fmt = lambda: {"format_type": "pdf", "isbn": r.choice([None, "", f"97812345678{r.randint(10, 40)}", "123456789X"]), "asin": None, "price": price(), "url": r.choice([None, "http://x"]), "url_status": r.choice([None, "valid", "unknown"]), "url_verified_at": None, "availability": None}
    edition = lambda n, last: {"edition_number": n, "edition_label": None, "publication_year": 2000 + n, "is_latest": last, "pages": r.choice([None, 9]), "description": r.choice([None, "", "d"]), "table_of_contents": None, "formats": [fmt() for _ in range(r.randint(0, 2))]}
    works = []
    for i in range(200):
        n = r.randint(1, 3)
        latest = r.randint(1, n + 1)
        works.append({
            "work_id": f"w{i}", "title": r.choice(["risk and bank", "bond funds", "tax law"]), "language": r.choice(["ja", "en"]), "publisher": r.choice(["", "Unknown", "P", None]), "authors": r.choice([None, ["Ann"], ["Bo", "Cy"]]),
            "segment": r.choice(["Other", "A", "B"]), "subsegment": "x", "perspective": "theory", "editions": [edition(k, k == latest) for k in range(1, n + 1)], "dataset_status": r.choice(["draft", "verified"]), "data_sources": ["s"], "updated_at": "then",
        })
    entry = lambda: {"isbn": r.choice([None, "9789999999999"]), "price": price(), "pages": r.choice([None, 77]), "description": r.choice([None, "long " * 500]), "publisher": r.choice([None, "Q"]), "title": r.choice(["Risk and Bank", "bond funds", "tax", None]), "authors": r.choice([None, ["ANN"], ["Dee"]])}
    catalogue = {f"97812345678{k}": entry() for k in range(10, 30)}
    volumes, by_title = {f"97812345678{k}": entry() for k in range(20, 41)} | {"123456789X": entry()}, {t: entry() for t in ("risk and bank", "bond funds")}
    ddl = f"isbn string, title string, ord int, entry {chain.ENTRY}"
    rows = lambda a, b: spark.createDataFrame([(k, None, o, e if o else {**e, "pages": 1}) for k, e in a.items() for o in (2, 1)] + [(None, k, 1, e) for k, e in b.items()], ddl)
    checked = {"https://www.amazon.com/s?k=tax+law": "https://f/1", "https://www.amazon.co.jp/s?k=9781234567825": "https://f/2", "https://www.amazon.com/dp/123456789X": "https://f/3", "https://www.amazon.com/s?k=bond+funds": None, "https://www.amazon.com/s?k=9789999999999": "https://f/4"}
    verdicts = {f"w{i}": (r.choice(["A", "B"]), r.choice(["x", "y"]), r.choice([0.5, 0.65, 0.9])) for i in range(0, 200, 2)}
    df = spark.createDataFrame(works, BOOK_V2)
    got = chain.enrich_works(
        df, [chain.Source("openbd", rows(catalogue, {}), languages=["ja"]), chain.Source("google", rows(volumes, by_title), by_title=True)], "now",
        checked=spark.createDataFrame([(k, v is not None, v) for k, v in checked.items()], "url string, valid boolean, final_url string"),
        verdicts=spark.createDataFrame([(k, *v, False) for k, v in verdicts.items()], "work_id string, new_segment string, new_subsegment string, confidence double, is_ambiguous boolean"), auto_apply=True,
    )
    got = {x.work_id: x for x in got.collect()}
    seen = set()
    for w in works:
        want, changes, reviews = fold(w, [("openbd", catalogue, None, ["ja"]), ("google", volumes, by_title, None)], checked, verdicts, True)
        x = got[w["work_id"]]
        assert x.changes == changes and [(v.source, v.reasons) for v in x.reviews] == reviews, (w, changes, x.changes)
        assert [e.asDict(True) for e in x.editions] == want["editions"]
        assert all(x[c] == want[c] for c in ("publisher", "segment", "subsegment", "dataset_status", "data_sources", "updated_at"))
        seen |= set(changes) | {q for _, v in reviews for q in v}
    assert len(seen) > 16
    assert chain.enrich_works(df.where(F.lit(False)), [], "now").count() == 0
