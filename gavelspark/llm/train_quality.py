"""Induces the rule list of :mod:`gavelspark.llm.quality`: python -m gavelspark.llm.train_quality SF_DIR

The labels are known by construction and use none of the statistics: prose is the
passages and questions of the evaluation items and the sentences below, in the
layouts prose comes in; everything else is rows of the other tables printed as lists,
tables, logs and dumps, random bytes, words in no order and garbled print.  Documents
are drawn from both, alone and mixed with a known share of visible characters.  At
most SAMPLE documents are made.  Prints the rules for ``quality_rules.py``, and their
accuracy, precision and recall on the fifth of the documents that is held out, whole
and with each rule left out.  Another fifth decides which rules and conditions earn
their place.
"""

from __future__ import annotations

import base64
import random
import re
import sys

from gavelspark.llm.quality import STATISTICS, text_statistics
from gavelspark.llm.rules import induce, predict

#: Labelled documents, at most.
SAMPLE = 12000
TABLES = ("persons", "legislative_sessions", "event_proposals", "house_positions", "candidates", "rename_transitions", "senate_winners", "fetch_events", "nation", "supplier")

#: Hand-written prose, for what the items do not hold: Spanish, and plain official English.
SENTENCES = [
    "The valley board heard two hours of comment before it put the vote off until spring.", "Nobody at the ferry landing could say when the repairs would be finished.",
    "She wrote that the new rule had cost her mill a third of its orders, and asked for a hearing.", "After the storm the county moved its records to the upper floor of the old school.",
    "If the levy fails again, the library will close on Mondays and shorten its other hours.", "They agreed to print the notice in both papers, though only one of them still has readers.",
    "In 1987 the dam was raised by four feet, which flooded the lower orchards for good.", "Applicants who miss the date may ask for one more month, but they must give a reason.",
    "Thank you for the careful answer; it settles most of what the neighbors were worried about.", "Motion carried without debate, and the members went down to lunch together.",
    "Our clinic saw twice as many people this winter as it did in the one before.", "What the report leaves out is who would pay for the second bridge.",
    "El consejo escuchó a los vecinos durante dos horas antes de aplazar la votación.", "Nadie supo decir cuándo quedaría reparado el camino de la ribera.",
    "La escuela cerró en marzo porque no había dinero para el tejado nuevo.", "Se pidió que el aviso saliera en los dos periódicos, aunque uno ya casi no se lee.",
    "Quienes lleguen tarde podrán pedir otro mes, pero tendrán que explicar el motivo.", "Después de la tormenta llevaron los archivos al piso de arriba del antiguo molino.",
    "Gracias por la respuesta; aclara casi todo lo que preocupaba a la gente del valle.", "En 1987 se levantó la presa y el agua cubrió las huertas de abajo para siempre.",
    "Si no se aprueba el impuesto, la biblioteca abrirá menos días que ahora.", "Lo que el informe no dice es quién pagaría el segundo puente.",
]


def visible(text: str) -> int:
    return len(re.sub(r"\s", "", text))


def wrapped(text: str, width: int) -> list[str]:
    out = [""]
    for w in text.split():
        if out[-1] and len(out[-1]) + len(w) >= width:
            out.append("")
        out[-1] = f"{out[-1]} {w}".strip()
    return out


def prose(rng: random.Random, sentences: list[str], names: list[str]) -> list[str]:
    """Lines of prose in one of its layouts."""
    text = " ".join(rng.choice(sentences) for _ in range(rng.choice([1, 1, 2, 4, 8, 15])))
    if rng.random() < 0.6:  # prose of offices is full of years, counts, sums and long words
        often = rng.uniform(0.02, 0.12)
        text = " ".join(x for w in text.split() for x in ([rng.choice([str(rng.randint(2, 99)), str(rng.randint(1950, 2025)), f"{rng.randint(2, 900)},000", rng.choice(names)]), w] if rng.random() < often else [w]))
    layout = rng.randrange(7)
    if layout == 0:
        return wrapped(text, rng.randint(35, 90))
    if layout == 1:
        return [text.upper()]
    if layout == 2:
        return [re.sub(r"[^\w ]", "", text.lower())]
    if layout == 3:
        return [f"{rng.choice(names).upper()}: {s}" for s in re.split(r"(?<=[.?]) ", text)]
    if layout == 4:
        return [f"({i}) {s}" for i, s in enumerate(re.split(r"(?<=[.?]) ", text), 1)]
    return [text] if layout == 5 else re.split(r"(?<=[.?]) ", text)


def other(rng: random.Random, sentences: list[str], rows: list[list[str]]) -> list[str]:
    """Lines of a list, a table, a log, a dump or junk."""
    some = [rng.choice(rows) for _ in range(rng.choice([2, 4, 6, 8, 10, 12, 25]))]
    short = [[v for v in r if 0 < len(v) <= 30] or ["x"] for r in some]
    kind = rng.choice([*range(14), 6, 6, 7, 14])
    if kind < 4:
        mark = [",", "\t", " | ", ";"][kind]
        return [mark.join(r) for r in some]
    if kind == 4:
        return ["<tr>" + "".join(f"<td>{v}</td>" for v in r[:6]) + "</tr>" for r in some]
    if kind == 5:
        return ["".join(v[:14].ljust(16) for v in r[:5]) for r in some]
    if kind == 6:
        bullet = rng.choice(["- ", "* ", "[ ] ", ""])
        return [bullet + rng.choice([" / ", ": ", ", ", " "]).join(rng.sample(r, min(len(r), rng.randint(1, 3)))) for r in short]
    if kind == 7:
        return [f"{i}. {rng.choice(r)}" for i, r in enumerate(short, 1)]
    if kind == 8:
        return [f"2{rng.randint(10, 99)}-{i:02d} {rng.choice(['INFO', 'WARN', 'run', 'ok'])} " + " ".join(f"{chr(97 + k)}={v}" for k, v in enumerate(r[:4])) for i, r in enumerate(some)]
    noise = bytes(rng.randrange(256) for _ in range(rng.randint(60, 900)))
    if kind == 9:
        return [base64.b64encode(noise).decode()]
    if kind == 10:
        return [f"{k:08x} {noise[k : k + 16].hex(' ')}" for k in range(0, len(noise), 16)]
    if kind == 14:  # one thing over and over
        return ["".join(chr(rng.randint(33, 255)) for _ in range(rng.randint(1, 6))) * rng.randint(9, 60)]
    if kind == 13:  # figures with a word between them
        short_ones = [w for w in re.findall(r"\w+", rng.choice(sentences)) if len(w) < 5] or ["of"]
        top = 10 ** rng.randint(1, 6)
        return [" ".join(x for _ in range(rng.randint(3, 15)) for x in (rng.choice(short_ones), str(rng.randrange(top)))) for _ in range(rng.randint(1, 9))]
    words = [w for s in (rng.choice(sentences) for _ in range(12)) for w in re.findall(r"\w{5,}", s)] + [str(rng.randrange(9999)) for _ in range(12)]
    if kind == 11:
        rng.shuffle(words)
        return [" ".join(words[: rng.randint(8, 80)]).lower()]
    spoilt = rng.uniform(0.15, 0.4)
    return ["".join(rng.choice("|~#;^¦*'`\\%&§¬0139") if c != " " and rng.random() < spoilt else c for c in rng.choice(sentences)) for _ in range(rng.randint(1, 8))]


def labelled(rng: random.Random, sentences: list[str], rows: list[list[str]], names: list[str]) -> tuple[str, float]:
    """A document and its share of prose."""
    blocks: list[tuple[list[str], bool]] = []
    mix = rng.random()
    for _ in range(rng.choice([1, 1, 2, 3])):
        good = rng.random() < mix
        blocks.append((prose(rng, sentences, names) if good else other(rng, sentences, rows), good))
    good, all_of = (sum(visible(x) for lines, g in blocks if g or every for x in lines) for every in (False, True))
    ends = rng.choice(["\n", "\n", "\r\n"])
    return ends.join(ends.join(lines) for lines, _ in blocks), good / max(1, all_of)


def main(sf_dir: str) -> None:
    import pandas as pd
    from pyspark.sql import functions as F

    from gavelspark.session import local_session, table

    spark = local_session(8)
    rng = random.Random(7)
    items = table(spark, sf_dir, "eval_items").select("passage", "question").orderBy("item_id").toPandas()
    passages = [s for t in items.passage.dropna() for s in re.split(r"(?<=[.?]) ", t)] + list(items.question.dropna())
    own = [s for s in SENTENCES for _ in range(max(1, len(passages) // len(SENTENCES)))]
    rows = []
    for name in TABLES:
        df = table(spark, sf_dir, name)
        rows += [[str(v) for v in r if v is not None] for r in df.orderBy(F.xxhash64(*[c for c in df.columns if c != "name_keys"])).limit(500).toLocalIterator()]
    names = [r[-1][:20] for r in rows if len(r) > 2]
    made = [(i, *labelled(rng, passages if rng.random() < 0.5 else own, rows, names)) for i in range(SAMPLE)]
    clear = pd.DataFrame([m for m in made if abs(m[2] - 0.5) > 0.04], columns=["doc_id", "text", "share"])
    stats = text_statistics(spark.createDataFrame(clear[["doc_id", "text"]])).toPandas().merge(clear, on="doc_id").sort_values("doc_id")
    x, y = stats[STATISTICS].fillna(0).to_numpy(float), (stats.share < 0.5).to_numpy()
    fold = (stats.doc_id % 5).to_numpy()
    held, check = fold == 0, fold == 1
    rules = induce(x[fold > 1], y[fold > 1], STATISTICS)
    right = lambda of, part: (predict(of, x[part], STATISTICS) == y[part]).mean()
    # A rule or condition without which the list is as good on the second fold goes.
    while True:
        fewer = [rules[:i] + rules[i + 1 :] for i in range(len(rules))]
        fewer += [rules[:i] + [r[:k] + r[k + 1 :]] + rules[i + 1 :] for i, r in enumerate(rules) for k in range(len(r)) if len(r) > 1]
        best = max(fewer, key=lambda of: right(of, check), default=rules)
        if best is rules or right(best, check) < right(rules, check):
            break
        rules = best
    print("RULES = [\n" + "".join(f"    {r!r},\n" for r in rules) + "]")

    def told(name: str, of: list) -> None:
        guess = predict(of, x[held], STATISTICS)
        print(name, held.sum(), "accuracy", round((guess == y[held]).mean(), 4), "precision", round((guess & y[held]).sum() / max(1, guess.sum()), 4), "recall", round((guess & y[held]).sum() / max(1, y[held].sum()), 4))

    told("held out:", rules)
    for i in range(len(rules)):
        told(f"without rule {i + 1}:", rules[:i] + rules[i + 1 :])


if __name__ == "__main__":
    main(sys.argv[1])
