"""spark-submit job: a night's matches -> graded topics."""

from __future__ import annotations

import argparse

from skyherald.jobs.config import load
from skyherald.session import build_session
from skyherald.sinks.tables import write_kafka
from skyherald.sources.tables import matches_stream
from skyherald.streaming.run import bounded_run
from skyherald.streaming.topics import stream_topics


def _text(path: str) -> str:
    with open(path) as f:
        return f.read()


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--matches", required=True)
    p.add_argument("--night", required=True, help="YYYYMMDD")
    p.add_argument("--config", required=True)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--kafka", help="bootstrap servers")
    p.add_argument("--files", help="folder for one sub-folder per topic instead of Kafka")
    p.add_argument("--topic-prefix", default="")
    p.add_argument("--avro-schema", help="file with the Avro schema of the payload; JSON without it")
    p.add_argument("--contract", help="file with the Avro schema that JSON records are resolved against")
    p.add_argument("--exit-after", type=float)
    p.add_argument("--interval", default="30 seconds")
    a = p.parse_args(argv)
    _, rules = load(a.config)
    spark = build_session(f"distribute-{a.night}")
    write = (lambda rows, batch_id: write_kafka(rows, a.kafka)) if a.kafka else None
    avro_schema, contract = (_text(path) if path else None for path in (a.avro_schema, a.contract))
    query = stream_topics(
        matches_stream(spark, a.matches, a.night), rules, a.checkpoint, path=a.files, write=write,
        interval=a.interval, prefix=a.topic_prefix, avro_schema=avro_schema, contract=contract,
    )
    bounded_run(query, a.exit_after)


if __name__ == "__main__":
    main()
