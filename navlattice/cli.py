"""Commands over folders of days: ingest, detect, export, plan.

    python -m navlattice.cli <command> [options]

Exit codes: 0 done, 1 differences found, 3 not published, 10 the day rests
after repeated failures, 12 the contract gate refused the day.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import avionics, calibrate, events, export, jumps, regions, reports, rollup, serve, store, verify
from .plans import backfill
from .sources import archive, days, dimensions, files, ingest, live
from .sources.archive import NotPublished

OK, DIFFERENT, NOT_PUBLISHED, QUARANTINED, CONTRACT = 0, 1, 3, 10, 12
SOURCE = events.SOURCE


def session() -> SparkSession:
    return SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()


def _folder(args) -> str:
    return days.day_dir(args.archive, SOURCE, args.date)


def _tables(spark: SparkSession, args) -> tuple[DataFrame, DataFrame]:
    return tuple(spark.read.parquet(f"{_folder(args)}/{t}") for t in (days.POSITIONS, days.HOURLY))


def _box(args, default: regions.Box | None = None) -> regions.Box | None:
    return None if getattr(args, "world", False) else regions.parse(args.bbox) if args.bbox else default


def _detected(positions: DataFrame, hourly: DataFrame, firs: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Jamming events without faulty aircraft, spoofing events, and the numbered jumps behind these."""
    sound = events.settled(serve.without(hourly, avionics.verdicts(hourly).where("faulty")))
    numbered = events.settled(jumps.sessions(jumps.unshared(jumps.jumps(positions))))
    return events.jamming_events(sound, firs=firs), jumps.events_of(numbered), numbered


def daily(spark: SparkSession, args) -> int:
    """Archives of a day to its positions (inside the box), world rollup and avionics report; one parse serves both tables."""
    paths = [a.split(",") for a in args.inputs]
    if not paths or not all(files.exists(p) for parts in paths for p in parts):
        raise NotPublished(f"{args.date}: no archive")
    documents = events.settled(archive.documents(spark, paths))
    ingest.gate(documents)
    reports_ = events.settled(ingest.traces(documents))
    box = _box(args, regions.ARCHIVE_BOX)
    inside = reports_ if box is None else reports_.where(regions.contains(box, F.col("lat"), F.col("lon")))
    hourly = events.settled(rollup.rollup(reports_))
    verdicts = avionics.verdicts(hourly)
    faulty = [r.icao24 for r in verdicts.where("faulty").select("icao24").orderBy("icao24").collect()]  # a few aircraft
    folder = days.write_day(inside, hourly, args.archive, SOURCE, args.date, box, {"avionics": avionics.report(verdicts).first().asDict() | {"faulty_aircraft": faulty}})
    print(f"{args.date}: {folder}")
    return OK


def check_contract(spark: SparkSession, args) -> int:
    try:
        days.require_rows(spark, _folder(args))
    except Exception as e:  # noqa: BLE001 - whatever is wrong with it, the day is not published
        print(f"{args.date}: {type(e).__name__}: {e}")
        return CONTRACT
    return OK


def verify_command(spark: SparkSession, args) -> int:
    days.check_day(spark, _folder(args))
    box = days.read_manifest(_folder(args))["bbox"]
    if box is None:
        raise ValueError("the positions are the world's: there is no box to compare in")
    positions, hourly = _tables(spark, args)
    r = verify.verify_day(hourly, positions, tuple(box)).first().asDict()
    print(json.dumps(r))
    return OK if r["avionics_same"] and not (r["only_stored"] or r["only_recomputed"] or r["different"]) else DIFFERENT


def jamming(spark: SparkSession, args) -> int:
    positions = ingest.json_lines(spark, args.inputs)
    print(reports.totals(positions).first().asDict())
    for table in (reports.sources(positions), reports.integrity(positions)):
        print([tuple(r) for r in table.orderBy(F.desc("n")).limit(50).collect()])
    hourly = events.settled(rollup.rollup(positions))
    faulty = avionics.verdicts(hourly).where("faulty")
    cells = events.settled(serve.cells(hourly if args.keep_faulty else serve.without(hourly, faulty), args.res))
    print([tuple(r) for r in reports.distribution(cells, "level").collect()])
    for r in reports.worst_cells(cells, args.top).select("h3", "n_bad", "n_total", "ratio_bad", "level").collect():
        print(tuple(r))
    if args.geojson:
        reports.geojson(cells, args.res).select("feature").write.mode("overwrite").text(args.geojson)
    return OK


def avionics_command(spark: SparkSession, args) -> int:
    hourly = events.settled(_tables(spark, args)[1])
    faulty = events.settled(avionics.verdicts(hourly).where("faulty"))
    print(avionics.report(avionics.verdicts(hourly)).first().asDict(), reports.faulty_share(hourly, faulty).first().asDict())
    for res in args.res:
        moves, changed = reports.filter_effect(hourly, faulty, res)
        print(res, sorted((tuple(r) for r in moves.collect()), key=lambda m: (reports.LEVELS.index(m[0]), m[1])))
        for r in changed.orderBy(F.desc("bad_before"), "h3").limit(args.top).collect():
            print(tuple(r))
    return OK


def spoofing(spark: SparkSession, args) -> int:
    numbered = events.settled(jumps.sessions(jumps.unshared(jumps.jumps(_tables(spark, args)[0]))))
    found = events.settled(jumps.events_of(numbered))
    print(numbered.count(), [tuple(r) for r in reports.distribution(found, "confidence").collect()])
    for r in reports.worst_spoofing(found, args.top).select("icao24", "confidence", "jumps", "start").collect():
        print(tuple(r))
    if args.json:
        events.spoof_payload(found, numbered, _box(args)).write.mode("overwrite").json(args.json)
    return OK


def events_command(spark: SparkSession, args) -> int:
    jam, spoof, numbered = _detected(*_tables(spark, args))
    all_ = events.settled(events.common(jam, events.spoof_common(spoof, numbered)))
    for column in ("type", "confidence"):
        print([tuple(r) for r in reports.distribution(all_, column).collect()])
    for r in reports.worst_events(all_, args.top).select("event_id", "type", "first_seen", "duration_hours", "affected_aircraft", "scale", "confidence", "fir").collect():
        print(tuple(r))
    if args.json:
        events.payload(all_, str(args.date), _box(args)).write.mode("overwrite").json(args.json)
    return OK


def export_static(spark: SparkSession, args) -> int:
    box = _box(args, regions.MAP_REGION)
    export.refuse_world(box, args.out)
    places, firs = dimensions.read_places(spark, args.places), dimensions.read_places(spark, args.firs)
    positions, hourly = _tables(spark, args)
    jam, spoof, numbered = _detected(positions, hourly, firs)
    all_ = events.settled(events.common(jam, events.spoof_common(spoof, numbered, firs)))
    extra = export.event_files(events.payload(all_, str(args.date), box), events.spoof_payload(spoof, numbered, box), args.date)
    print(export.export_day(hourly, args.date, args.out, places, firs, box, extra=extra))
    files.write_documents(export.range_file(hourly), args.out).count()
    if args.database:
        store.migrate(spark, args.database)
        store.replace_days(store.event_rows(all_), f"{args.database}.events")
    return OK


def load_hourly(spark: SparkSession, args) -> int:
    store.migrate(spark, args.database)
    store.replace_days(store.hourly_rows(_tables(spark, args)[1]), f"{args.database}.hourly")
    return OK


def load(spark: SparkSession, args) -> int:
    store.migrate(spark, args.database)
    store.replace_days(store.position_rows(ingest.json_lines(spark, args.inputs)), f"{args.database}.positions")
    return OK


def aggregate(spark: SparkSession, args) -> int:
    """Rebuilds whole hours of the serving rollup from its positions, once or again and again."""
    while True:
        end = args.end or dt.datetime.now(dt.UTC).replace(tzinfo=None)
        start = args.start or end - dt.timedelta(hours=args.hours_back)
        first, last = (d.strftime("%Y-%m-%d %H:%M:%S") for d in (start.replace(hour=0, minute=0, second=0), end))
        stored = regions.in_time(spark.table(f"{args.database}.positions"), first, last)
        store.replace_days(store.hourly_rows(rollup.rollup(stored)), f"{args.database}.hourly")
        if not args.every:
            return OK
        time.sleep(args.every)


def live_command(spark: SparkSession, args) -> int:
    from .streaming.hourly import poll_loop

    box = _box(args, regions.FOCUS_BOX)

    def step() -> None:
        got = live.poll(box, lambda lat, lon, radius: args.url.format(lat=lat, lon=lon, radius=radius))
        ingest.write_json_lines(live.snapshot(live.answers(spark, got), box).drop("snapshot_id"), args.out)

    poll_loop(step, args.every, args.times)
    return OK


def publish(spark: SparkSession, args) -> int:
    target = days.day_dir(args.to, SOURCE, args.date)
    source = _folder(args)
    if args.restore:
        source, target = target, source
    days.copied(spark, source, target)
    return OK


def plan(spark: SparkSession, args) -> int:
    end = args.end or dt.datetime.now(dt.UTC).date() - dt.timedelta(days=1)
    table = lambda found: spark.createDataFrame([(d,) for d in sorted(found)], "day date")
    have, out = table(days.archived(args.archive, SOURCE, args.start, end)), table(backfill.exported(args.static))
    todo = backfill.plan(backfill.days(spark, args.start, end), have, out, backfill.Ledger.load(args.state).table(spark), dt.datetime.now(dt.UTC).replace(tzinfo=None), args.max_attempts, args.cooldown_days)
    for r in todo.collect():  # a row a day
        print(r.day, r.mode)
    return OK


def mark(spark: SparkSession, args) -> int:
    ledger, rests = backfill.Ledger.load(args.state), False
    if args.failed:
        rests = ledger.failed(args.date, args.error, dt.datetime.now(dt.UTC).replace(tzinfo=None), args.max_attempts, args.cooldown_days)
    else:
        ledger.succeeded(args.date)
    ledger.save(args.state)
    return QUARANTINED if rests else OK


def matrix(spark: SparkSession, args) -> int:
    end = args.end or dt.datetime.now(dt.UTC).date() - dt.timedelta(days=1)
    have = days.archived(args.archive, SOURCE, args.start, end)
    todo = [r.day for r in backfill.missing(backfill.days(spark, args.start, end), spark.createDataFrame([(d,) for d in sorted(have)], "day date")).collect()]
    print(json.dumps({"matrix": backfill.matrix(todo, args.chunk), "parallel": backfill.parallel(args.parallel), "months": sorted({f"{d:%Y-%m}" for d in todo})}))
    return OK


def process_days(spark: SparkSession, args) -> int:
    """Day after day within a time budget: daily, gate, publish; one bad day does not stop the others."""
    began, told = time.monotonic(), {"done": [], "missing": [], "failed": [], "left": []}
    for day in args.days:
        args.date = dt.date.fromisoformat(day)
        args.inputs = [args.pattern.format(day=args.date)]
        if time.monotonic() - began >= args.budget:
            told["left"].append(day)
            continue
        try:
            code = daily(spark, args) or check_contract(spark, args) or (publish(spark, args) if args.to else OK)
            told["done" if code == OK else "missing" if code == NOT_PUBLISHED else "failed"].append(day)
        except NotPublished:
            told["missing"].append(day)
        except Exception as e:  # noqa: BLE001
            print(f"{day}: {type(e).__name__}: {e}")
            told["failed"].append(day)
    print(json.dumps(told))
    return DIFFERENT if told["failed"] else OK


def calibrate_command(spark: SparkSession, args) -> int:
    """What the thresholds make of all archived days."""
    found = None
    for day in sorted(days.archived(args.archive, SOURCE, args.start, args.end or dt.date.today())):
        hourly = events.settled(spark.read.parquet(f"{days.day_dir(args.archive, SOURCE, day)}/{days.HOURLY}"))
        part, chance = calibrate.day_events(hourly, str(day))
        print(chance.first().asDict())
        part = events.settled(part)
        found = part if found is None else found.unionByName(part)
    if found is not None:
        for name, table in calibrate.report(found).items():
            print(name, [r.asDict() for r in table.collect()])  # some rows each
    return OK


def build_airports(spark: SparkSession, args) -> int:
    files.write_documents(dimensions.airport_features(dimensions.airports(dimensions.read_airports(spark, args.input))), args.out).count()
    return OK


def build_places(spark: SparkSession, args) -> int:
    land = dimensions.geojson_shapes(spark, files.get(args.countries).decode(), "country", "NAME", "NAME_TR")
    seas = dimensions.geojson_shapes(spark, files.get(args.seas).decode(), "sea", "name", "name_tr", land.count())
    files.put(f"{args.out}/places.json", dimensions.document(dimensions.places(land.unionByName(seas), dimensions.MERGED), "places", args.source).encode())
    return OK


def build_firs(spark: SparkSession, args) -> int:
    shapes = dimensions.fir_shapes(spark, files.get(args.shp), files.get(args.dbf))
    files.put(f"{args.out}/firs.json", dimensions.document(dimensions.regions(shapes), "firs", args.source).encode())
    return OK


def migrate(spark: SparkSession, args) -> int:
    print(store.migrate(spark, args.database), "statements")
    return OK


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="navlattice", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = p.add_subparsers(required=True, dest="command")

    def command(name, run, *options):
        c = sub.add_parser(name, help=(run.__doc__ or "").partition("\n")[0])
        c.set_defaults(run=run)
        for flags, kind in options:
            c.add_argument(*([flags] if isinstance(flags, str) else flags), **kind)

    date, day, folder = dt.date.fromisoformat, ("--date", {"type": dt.date.fromisoformat, "required": True}), ("--archive", {"default": "data/archive"})
    bbox, top = ("--bbox", {}), ("--top", {"type": int, "default": 10})
    world, out_json = ("--world", {"action": "store_true"}), ("--json", {})
    database, state = ("--database", {"default": "navlattice"}), ("--state", {"default": "data/state"})
    span = (("--start", {"type": date, "default": archive.FIRST_DAY}), ("--end", {"type": date}))
    rest = (("--max-attempts", {"type": int, "default": backfill.MAX_ATTEMPTS}), ("--cooldown-days", {"type": int, "default": backfill.COOLDOWN_DAYS}))
    command("daily", daily, day, folder, bbox, world, ("--inputs", {"nargs": "*", "default": []}))
    command("check-contract", check_contract, day, folder)
    command("verify", verify_command, day, folder)
    command("jamming", jamming, ("inputs", {}), ("--res", {"type": int, "default": 4}), top, ("--keep-faulty", {"action": "store_true"}), ("--geojson", {}))
    command("avionics", avionics_command, day, folder, top, ("--res", {"type": int, "nargs": "*", "default": [3, 4, 5]}))
    command("spoofing", spoofing, day, folder, bbox, top, out_json)
    command("events", events_command, day, folder, bbox, top, out_json)
    command("export-static", export_static, day, folder, bbox, world, ("--out", {"required": True}), ("--places", {"required": True}), ("--firs", {"required": True}), ("--database", {}))
    command("load-hourly", load_hourly, day, folder, database)
    command("load", load, ("inputs", {}), database)
    command("aggregate", aggregate, database, ("--start", {"type": dt.datetime.fromisoformat}), ("--end", {"type": dt.datetime.fromisoformat}), ("--hours-back", {"type": int, "default": 3}), ("--every", {"type": float}))
    command("live", live_command, bbox, ("--out", {"required": True}), ("--url", {"required": True}), ("--every", {"type": float, "default": 90}), ("--times", {"type": int}))
    command("publish", publish, day, folder, ("--to", {"required": True}), ("--restore", {"action": "store_true"}))
    command("plan", plan, folder, state, *span, *rest, ("--static", {"default": "data/static"}))
    command("mark", mark, day, state, *rest, ("--failed", {"action": "store_true"}), ("--error", {"default": ""}))
    command("matrix", matrix, folder, *span, ("--chunk", {"type": int, "default": backfill.CHUNK_DAYS}), ("--parallel", {"type": int}))
    command("process-days", process_days, folder, bbox, world, ("days", {"nargs": "+"}), ("--pattern", {"required": True}), ("--to", {}), ("--restore", {"action": "store_true"}), ("--budget", {"type": float, "default": backfill.BUDGET_S}))
    command("migrate", migrate, database)
    command("calibrate", calibrate_command, folder, *span)
    out, source = ("--out", {"required": True}), ("--source", {"default": ""})
    command("build-airports", build_airports, ("input", {}), out)
    command("build-places", build_places, ("countries", {}), ("seas", {}), out, source)
    command("build-firs", build_firs, ("shp", {}), ("dbf", {}), out, source)
    return p


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(arguments)
    try:
        return args.run(spark or session(), args)
    except NotPublished as e:
        print(e)
        return NOT_PUBLISHED


if __name__ == "__main__":
    sys.exit(main())
