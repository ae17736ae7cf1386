"""Command line: the lakehouse runs and the stream detector.

    python -m sentinela bronze --sf-dir DIR [--root ROOT]        full load -> Bronze, prints the manifest
    python -m sentinela bronze --jdbc-url URL [--jdbc-property K=V]... [--key-range TABLE:COLUMN:LOW:HIGH:PARTS]...
    python -m sentinela silver [--root ROOT] [--snapshot all|latest]   Bronze -> Silver, prints the quality report
    python -m sentinela gold   [--root ROOT] [--snapshot all|latest]   Silver -> Gold marts, prints the insights
    python -m sentinela replay --sf-dir DIR --out DIR [--slices N]     stored transactions -> JSON event files
    python -m sentinela stream --source DIR|--kafka HOST:PORT --topic T --out DIR [--checkpoint DIR] [--continuous]

``--root`` defaults to ``<spark.checkpoint.dir>/sentinela/lake``. The
``--sf-dir`` source is the provided test-data folder (the five source tables
are derived from it). ``--jdbc-url`` loads the five tables of a relational
database instead; a table with a ``--key-range`` is read by several tasks.
``--defaults`` fills NULLs with the source schema's column defaults.
"""

from __future__ import annotations

import argparse
import json

from sentinela.session import build_session, shared_root


def _root(spark, given: str | None) -> str:
    return given or f"{shared_root(spark)}/sentinela/lake"


def key_ranges(given: list[str]) -> dict[str, tuple[str, int, int, int]]:
    """``TABLE:COLUMN:LOW:HIGH:PARTS`` arguments as the partitioning of ``jdbc_source``."""
    out = {}
    for text in given:
        table, column, low, high, parts = text.split(":")
        out[table] = (column, int(low), int(high), int(parts))
    return out


def properties(given: list[str]) -> dict[str, str]:
    return dict(x.split("=", 1) for x in given)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="sentinela")
    ap.add_argument("command", choices=["bronze", "silver", "gold", "replay", "stream"])
    ap.add_argument("--sf-dir")
    ap.add_argument("--jdbc-url")
    ap.add_argument("--jdbc-property", action="append", default=[], metavar="KEY=VALUE")
    ap.add_argument("--key-range", action="append", default=[], metavar="TABLE:COLUMN:LOW:HIGH:PARTS")
    ap.add_argument("--defaults", action="store_true")
    ap.add_argument("--mode", default="arrival", choices=["arrival", "clock", "event_time"])
    ap.add_argument("--root")
    ap.add_argument("--snapshot", default="all", choices=["all", "latest"])
    ap.add_argument("--layout", default="events", choices=["events", "orders"])
    ap.add_argument("--out")
    ap.add_argument("--slices", type=int, default=4)
    ap.add_argument("--source")
    ap.add_argument("--kafka")
    ap.add_argument("--topic")
    ap.add_argument("--checkpoint")
    ap.add_argument("--continuous", action="store_true")
    ap.add_argument("--master", default="local[*]")
    ap.add_argument("--size-to-input", action="store_true",
                    help="set shuffle partitions / scan splits from the size of --sf-dir or --root")
    a = ap.parse_args(argv)

    spark = build_session(a.master, app=f"sentinela-{a.command}")
    if a.size_to_input and (a.sf_dir or a.root):
        from sentinela.session import apply_sized_settings
        apply_sized_settings(spark, a.sf_dir or a.root)
    from sentinela.plans import medallion
    from sentinela.plans.layers import Layers
    from sentinela.sources import lake
    if a.command == "bronze":
        if a.jdbc_url:
            source = lake.jdbc_source(spark, a.jdbc_url, properties(a.jdbc_property), key_ranges(a.key_range))
        else:
            bronze = Layers(spark, a.sf_dir, a.layout).bronze
            source = lake.TableSource(lambda t: bronze[t])
        print(json.dumps(medallion.run_bronze(spark, source, _root(spark, a.root), defaults=a.defaults),
                         ensure_ascii=False, indent=2, default=str))
    elif a.command == "silver":
        print(json.dumps(medallion.run_silver(spark, _root(spark, a.root), snapshot=a.snapshot),
                         ensure_ascii=False, indent=2, default=str))
    elif a.command == "gold":
        print(json.dumps(medallion.run_gold(spark, _root(spark, a.root), snapshot=a.snapshot),
                         ensure_ascii=False, indent=2, default=str))
    elif a.command == "replay":
        from sentinela.streaming import events as sev
        silver = Layers(spark, a.sf_dir, a.layout).silver
        print(json.dumps(sev.write_event_files(sev.events_from_tables(silver), a.out, a.slices)))
    else:
        from sentinela.streaming import alerts as sal
        from sentinela.streaming import events as sev
        raw = sev.kafka_source(spark, a.kafka, a.topic) if a.kafka else sev.text_source(spark, a.source)
        checkpoint = a.checkpoint or f"{a.out}/_checkpoint"
        if a.continuous:
            for start in (lambda: sal.start_detector(raw, a.out, checkpoint, False, mode=a.mode),
                          lambda: sal.start_alert_sink(spark, a.out, checkpoint, False),
                          lambda: sal.start_counters(spark, a.out, checkpoint, False)):
                start()
            spark.streams.awaitAnyTermination()
        else:
            sal.run_available(raw, a.out, checkpoint, mode=a.mode)
        print(json.dumps([r.asDict() for r in sal.alert_rate(spark, checkpoint).collect()]))


if __name__ == "__main__":
    main()
