"""Personal data planted among candidates that look like it: precision and recall by kind."""

import random

from terraloom.llm import pii
from terraloom.llm.shared import fresh_path

WORDS = "the river runs past old mills and slow barges carry grain to the town while birds turn over the fields".split()


def planted(n=400):
    rng = random.Random(9)
    prose = lambda: " ".join(rng.choices(WORDS, k=rng.randrange(8, 20)))
    key = lambda k: "".join(rng.choices("0123456789abcdef", k=k))
    mixed = lambda: "".join(rng.choices("abcdefghijkmnpqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789", k=28)) + "7q"
    city = lambda: rng.choice(("London", "Paris", "Berlin", "Madrid", "Lyon", "Boston"))
    name = lambda: rng.choice(("Mill", "Church", "Station", "Garden", "Castle"))
    true = [
        ("secret", lambda: ('password = "', mixed(), '"')),
        ("secret", lambda: ("Passwort: ", mixed(), "")),
        ("secret", lambda: ("contraseña: ", mixed(), "")),
        ("secret", lambda: ('api_key="', key(40), '"')),
        ("secret", lambda: ("", "ghp_" + mixed(), "")),
        ("address", lambda: ("write to ", f"{rng.randrange(1, 99)} {name()} Street", f", {city()}")),
        ("address", lambda: ("adresse: ", f"{rng.randrange(1, 99)} rue de la {name()}", f", 75001 {city()}")),
        ("address", lambda: ("Anschrift: ", f"{name()}straße {rng.randrange(1, 99)}", f", 10115 {city()}")),
        ("address", lambda: ("dirección ", f"calle {name()} {rng.randrange(1, 99)}", f", 28001 {city()}")),
    ]
    false = [
        lambda: f"commit {key(40)} by",
        lambda: f"see issue-{rng.randrange(999)}-about-the-mill",
        lambda: f"{rng.randrange(1, 9)} Miles Road",  # no place, no postcode, no cue
        lambda: f"the ring {rng.randrange(9)} of the mill",
        lambda: f"md5 {key(32)} of",
        lambda: "camel_case_name_2 in",
        lambda: f"way {rng.randrange(9)} over",
    ]
    rows, want = [], {}
    for i in range(n):
        text, spans = prose(), set()
        for _ in range(rng.randrange(1, 4)):
            if rng.random() < 0.6:
                kind, make = rng.choice(true)
                before, span, after = make()
                start = len(text) + 1 + len(before)
                text += f" {before}{span}{after}"
                spans.add((kind, start, start + len(span)))
            else:
                text += " " + rng.choice(false)()
            text += " " + prose()
        rows.append((i, text))
        want[i] = spans
    return rows, want


def test_precision_and_recall_on_planted_spans(spark):
    rows, want = planted()
    out = pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string"), fresh_path(spark, "pii"))
    got = {r.doc_id: {(pii.KINDS[s.kind], s.start, s.end) for s in r.spans if not s.base} for r in out.collect()}
    for kind in ("secret", "address"):
        found = {(i, *s) for i, spans in got.items() for s in spans if s[0] == kind}
        true = {(i, *s) for i, spans in want.items() for s in spans if s[0] == kind}
        assert len(found & true) >= 0.9 * len(true), (kind, sorted(true - found)[:5])
        assert len(found & true) >= 0.95 * len(found), (kind, sorted(found - true)[:5])


def test_addresses_of_four_languages_and_none_in_prose():
    cases = {
        "at 12 High Street, London": "12 High Street",
        "au 5 bis, rue de la Paix, 75002 Paris": "5 bis, rue de la Paix",
        "en la calle Mayor 14, Madrid": "calle Mayor 14",
        "Lindenstraße 7a, 10969 Berlin": "Lindenstraße 7a",
        "Plaza del Sol, n.º 3": "Plaza del Sol, n.º 3",
    }
    for text, span in cases.items():
        assert [text[a:b] for k, a, b, _ in pii.raw_matches(text) if k == pii.ADDRESS] == [span], text
    for text in ("the road to the mill", "a long way 7 miles", "Rue the day", "ring ring 5", "In 1984 the Street was long", ""):
        assert not [1 for k, *_ in pii.raw_matches(text) if k == pii.ADDRESS], text


def test_gazetteers_are_lists_of_their_own():
    for name in ("secret_words", "contact_words", "street_words", "places"):
        entries = pii.gazetteer(name)
        assert len(set(entries)) == len(entries) > 15 and all(e == e.strip() and e for e in entries)
