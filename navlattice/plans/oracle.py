"""DuckDB SQL for the registered queries."""

from __future__ import annotations

from ..sources.fixtures import FIRS, PLACES
from .queries import CELL, INNER

POS = """e AS (SELECT event_id, user_id, event_type, value, epoch_us(ts) - 1704067200000000 AS us, CAST(json_extract_string(props, '$.k') AS INT) AS k, user_id % 3 AS zone FROM events),
m AS (SELECT *, us // 30000 AS ts_ms, (us // 30000) // 3600000 AS hr FROM e),
pos AS (SELECT 1704067200000 + ts_ms AS ts_ms, lpad(lower(hex(user_id)), 6, '0') AS icao24,
  CASE zone WHEN 0 THEN 41e0 WHEN 1 THEN 34e0 ELSE 50e0 END + ((event_id*7919)%1000)*2e-4 + CASE WHEN event_type='error' AND k<20 THEN 2e0 ELSE 0e0 END AS lat,
  CASE zone WHEN 0 THEN 29e0 WHEN 1 THEN 35e0 ELSE 8e0 END + ((event_id*104729)%1000)*2e-4 AS lon,
  CAST(CASE WHEN k=98 THEN NULL ELSE value*500e0 END AS FLOAT) AS alt, CASE WHEN k%3=0 THEN NULL ELSE concat('CS', user_id) END AS callsign,
  CAST(CASE WHEN k=99 THEN NULL WHEN user_id%17=0 THEN k%4 WHEN zone=1 AND hr BETWEEN 6 AND 17 AND k<60 THEN k%5 WHEN k<2 THEN 4 ELSE 7+k%5 END AS INT) AS nic,
  CAST(CASE WHEN k%10=9 THEN NULL ELSE 6+k%5 END AS INT) AS nac_p,
  CASE WHEN k BETWEEN 90 AND 94 THEN 'adsblol:mlat' WHEN k=95 THEN 'unknown' WHEN k%2=0 THEN 'adsblol:adsb_icao' ELSE 'adsblol:adsb_icao_nt' END AS source,
  event_type='signup' AND k<10 AS on_ground, user_id%23=0 AS anonymous FROM m)"""

_HIST = " , ".join(f"count(*) FILTER (WHERE least(nic,11)={i}) AS bin{i}" for i in range(12))
_SUMS = ", ".join(f"CAST(sum(bin{i}) AS BIGINT) AS bin{i}" for i in range(12))
_TEXT = "concat_ws(',', " + ", ".join(f"bin{i}" for i in range(12)) + ") AS nic_hist"
CELL5 = "(7::BIGINT<<59)|(5::BIGINT<<52)|(CAST(floor((lat+90)/0.125) AS BIGINT)<<20)|CAST(floor((lon+180)/0.125) AS BIGINT)"


def parent(res: int, h: str = "h3") -> str:
    step = 3 ** (5 - res)
    return h if res == 5 else f"((7::BIGINT<<59)|({res}::BIGINT<<52)|(((({h}>>20)&1048575)//{step})<<20)|(({h}&1048575)//{step}))"


ROLL = POS + f""",
elig AS (SELECT * FROM pos WHERE NOT on_ground AND nic IS NOT NULL AND (source='unknown' OR split_part(source, ':', -1) IN ('adsb_icao','adsb_icao_nt'))),
uniq AS (SELECT *, {CELL5} AS h3, make_timestamp((ts_ms//3600000)*3600000000) AS hour FROM elig QUALIFY row_number() OVER (PARTITION BY icao24, ts_ms ORDER BY lat, lon, nic)=1),
roll AS (SELECT hour, h3, icao24, arg_max(callsign, ts_ms) FILTER (WHERE callsign<>'') AS callsign, count(*) AS r, count(*) FILTER (WHERE nic<5) AS b, min(nic) AS mn, bool_or(anonymous) AS anon,
  count(*) FILTER (WHERE alt<5000) AS lr, count(*) FILTER (WHERE alt<5000 AND nic<5) AS lb, count(nac_p) AS np, count(*) FILTER (WHERE nac_p<8) AS lnp, {_HIST} FROM uniq GROUP BY ALL)"""
_OUT = "callsign, r AS n_reports, b AS n_bad_reports, mn AS min_nic, anon AS anonymous, lr AS n_low_reports, lb AS n_low_bad_reports, np AS n_nacp_reports, lnp AS n_low_nacp_reports"


def _ac(keys: str, source: str = "roll") -> str:
    """Sums by keys and aircraft."""
    head = f"{keys}, " if keys else ""
    return f"SELECT {head}icao24, arg_max(callsign, hour) FILTER (WHERE callsign<>'') AS callsign, CAST(sum(r) AS BIGINT) AS r, CAST(sum(b) AS BIGINT) AS b, min(mn) AS mn, bool_or(anon) AS anon, CAST(sum(lr) AS BIGINT) AS lr, CAST(sum(lb) AS BIGINT) AS lb, CAST(sum(np) AS BIGINT) AS np, CAST(sum(lnp) AS BIGINT) AS lnp, {_SUMS}, 2*sum(b)>=sum(r) AS aff FROM {source} GROUP BY {head}icao24"


_TAIL = "list_sum(list_transform(range(0, CAST({k} AS BIGINT)), lambda i: exp(lgamma({n}+1e0)-lgamma(i+1e0)-lgamma({n}-i+1e0)+i*ln(0.015e0)+({n}-i)*ln(0.985e0))))"
TAIL = "CASE WHEN {k}<=0 THEN 1e0 WHEN {k}>{n} THEN 0e0 ELSE greatest(0e0, 1e0-" + _TAIL + ") END"
LEVEL = "CASE WHEN {n}<5 THEN 'noData' WHEN {k}/{n}<=0.025e0 OR " + TAIL + ">=0.01e0 THEN 'low' WHEN {k}/{n}>=0.1e0 THEN 'high' ELSE 'medium' END"
_W = "1.96e0*sqrt(({k}/{n})*(1-{k}/{n})/{n}+3.8416e0/(4e0*{n}*{n}))"
WIDTH = "(least(1e0,({k}/{n}+3.8416e0/(2*{n})+" + _W + ")/(1+3.8416e0/{n}))-greatest(0e0,({k}/{n}+3.8416e0/(2*{n})-" + _W + ")/(1+3.8416e0/{n})))"
CONF = "CASE WHEN {n}<5 THEN 'none' WHEN {n}<20 THEN 'low' WHEN {n}>=100 AND " + WIDTH + "<=0.08e0 THEN 'high' ELSE 'medium' END"
SCALE = "CASE WHEN {k}>=30 THEN 'large' WHEN {k}>=10 THEN 'medium' ELSE 'small' END"
_CRUISE = "count(*) FILTER (WHERE r>lr) AS n_total_cruise, count(*) FILTER (WHERE r>lr AND 2*(b-lb)>=r-lr) AS n_bad_cruise"


def _f(t: str, n: str = "n_total", k: str = "n_bad") -> str:
    return t.replace("{n}", n).replace("{k}", k)


def cells(res: int, source: str = "roll", extra: bool = True) -> str:
    more = f", n_total_cruise, n_bad_cruise, {_f(CONF)} AS confidence, round(n_bad/n_total, 4) AS ratio_bad" if extra else ""
    return f"SELECT h3, n_total, n_bad, {_f(LEVEL)} AS level{more} FROM (SELECT h3, count(*) AS n_total, count(*) FILTER (WHERE aff) AS n_bad, {_CRUISE} FROM ({_ac(parent(res) + ' AS h3', source).replace(f'GROUP BY {parent(res)} AS h3', f'GROUP BY {parent(res)}')}) GROUP BY h3)"


PART = f"part AS (SELECT * FROM roll WHERE {parent(3)}={CELL})"
PEERS = f"""fine AS ({_ac('hour, p3', f"(SELECT *, {parent(3)} AS p3 FROM roll)")}),
peers AS (SELECT hour, p3 AS h3, icao24, aff AS affected, count(*) OVER w - 1 AS peers, CAST(sum(aff::INT) OVER w AS BIGINT) - aff::BIGINT AS affected_peers FROM fine WINDOW w AS (PARTITION BY hour, p3)),
peer AS (SELECT *, peers>=3 AND affected_peers<=0.2e0*peers AS clean FROM peers),
verd AS (SELECT icao24, count(*) AS buckets, count(*) FILTER (WHERE clean) AS clean_buckets, count(*) FILTER (WHERE clean AND affected) AS bad_in_clean FROM peer GROUP BY icao24),
verdict AS (SELECT *, clean_buckets>=3 AND bad_in_clean>=0.8e0*clean_buckets AS faulty FROM verd),
sound AS (SELECT * FROM roll WHERE icao24 NOT IN (SELECT icao24 FROM verdict WHERE faulty))"""
NODES = f"""acs AS ({_ac('hour, h3', 'sound')}), node0 AS (SELECT hour, h3, count(*) AS n_total, count(*) FILTER (WHERE aff) AS n_bad, bool_or(aff AND anon) AS anonymous FROM acs GROUP BY hour, h3),
nodes AS (SELECT *, {_f(LEVEL)} AS level FROM node0)"""
HOT = """hot AS (SELECT *, ((epoch_us(hour)//3600000000)<<23)|(((h3>>20)&1048575)<<12)|(h3&1048575) AS node, (h3>>20)&1048575 AS y, h3&1048575 AS x FROM nodes WHERE level IN ('medium','high')),
edge AS (SELECT a.node AS a, b.node AS b FROM hot a JOIN hot b ON abs(a.y-b.y)<=1 AND (abs(a.x-b.x)<=1 OR abs(a.x-b.x)=2879) AND abs(epoch_us(a.hour)-epoch_us(b.hour))<=3600000000 AND CAST(a.hour AS DATE)=CAST(b.hour AS DATE)),
reach AS (SELECT a, b FROM edge UNION SELECT reach.a, edge.b FROM reach JOIN edge ON reach.b=edge.a),
comp AS (SELECT a AS node, min(b) AS component FROM reach GROUP BY a)"""
JUMPS = """lagged AS (SELECT icao24, ts_ms, lat, lon, nic, source, on_ground, anonymous, lag(ts_ms) OVER w AS ts0, lag(lat) OVER w AS lat0, lag(lon) OVER w AS lon0, lag(nic) OVER w AS nic0, lag(source) OVER w AS source0, lag(on_ground) OVER w AS ground0, lag(anonymous) OVER w AS anon0 FROM pos WINDOW w AS (PARTITION BY icao24 ORDER BY ts_ms, lat, lon)),
dist AS (SELECT *, (ts_ms-ts0)/1000e0 AS dt, 2*3440.065e0*asin(least(1e0, sqrt(pow(sin(radians(lat-lat0)/2),2)+cos(radians(lat0))*cos(radians(lat))*pow(sin(radians(lon-lon0)/2),2)))) AS d FROM lagged WHERE ts0 IS NOT NULL AND NOT on_ground AND NOT ground0 AND source NOT LIKE '%mlat' AND source0 NOT LIKE '%mlat'),
jump AS (SELECT *, d/(dt/3600) AS v FROM dist WHERE dt BETWEEN 1 AND 120 AND d>=10 AND d/(dt/3600)>1500)"""


HAV = "2*3440.065e0*asin(least(1e0, sqrt(pow(sin(radians({b}-({a}))/2),2)+cos(radians({a}))*cos(radians({b}))*pow(sin(radians({d}-({c}))/2),2))))"


def hav(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return HAV.format(a=lat1, b=lat2, c=lon1, d=lon2)


SESSIONS = f"""ends AS (SELECT *, row_number() OVER (PARTITION BY icao24 ORDER BY ts_ms, lat0, lon0, lat, lon, side) AS rn FROM (SELECT icao24, ts_ms, lat0, lon0, lat, lon, 0 AS side, lat0 AS la, lon0 AS lo FROM jump UNION ALL SELECT icao24, ts_ms, lat0, lon0, lat, lon, 1, lat, lon FROM jump)),
away AS (SELECT e.*, c.la AS la1, c.lo AS lo1 FROM ends e JOIN ends c ON c.icao24=e.icao24 AND c.rn=1 WHERE {hav('e.la', 'e.lo', 'c.la', 'c.lo')}>30),
second AS (SELECT * FROM away QUALIFY row_number() OVER (PARTITION BY icao24 ORDER BY rn)=1),
third AS (SELECT DISTINCT a.icao24 FROM away a JOIN second c ON c.icao24=a.icao24 WHERE {hav('a.la', 'a.lo', 'c.la', 'c.lo')}>30),
shared AS (SELECT icao24 FROM second WHERE icao24 NOT IN (SELECT icao24 FROM third) AND icao24 IN (SELECT icao24 FROM jump GROUP BY icao24 HAVING count(*)>=4)),
good AS (SELECT * FROM jump WHERE icao24 NOT IN (SELECT icao24 FROM shared)),
sess AS (SELECT *, sum(CASE WHEN prev IS NULL OR ts0-prev>600000 THEN 1 ELSE 0 END) OVER (PARTITION BY icao24 ORDER BY ts0, ts_ms ROWS UNBOUNDED PRECEDING) AS session, floor(lat/2) AS gy, floor(lon/2) AS gx, ts_ms//600000 AS gt FROM (SELECT *, lag(ts_ms) OVER (PARTITION BY icao24 ORDER BY ts0, ts_ms) AS prev FROM good)),
conv AS (SELECT gy, gx, gt, min(icao24)<>max(icao24) AS converging FROM sess GROUP BY ALL),
spoof AS (SELECT icao24, session, min(ts0) AS s, max(ts_ms) AS e, count(*) AS n, max(d) AS md, max(v) AS mv, arg_min(lat0, ts_ms) AS la, arg_min(lon0, ts_ms) AS lo, bool_or(anon0 OR anonymous) AS anon, CASE WHEN bool_or(converging OR coalesce(nic0>=7 AND nic>=7, false)) THEN 'high' WHEN bool_and(coalesce(nic0,0)=0 OR coalesce(nic,0)=0) THEN 'integrity_overlap' ELSE 'low' END AS conf
  FROM sess JOIN conv USING (gy, gx, gt) GROUP BY icao24, session)"""


def edges(which: tuple, name: str) -> str:
    """The edges of a dimension's rings and its heads, as tables of values."""
    rows = [f"({o},{pi},{ri},{x0}e0,{y0}e0,{x1}e0,{y1}e0)" for o, (_, _, polys) in enumerate(which) for pi, poly in enumerate(polys) for ri, ring in enumerate(poly) for (x0, y0), (x1, y1) in zip(ring, ring[1:], strict=False)]
    heads = [f"({o},'{kind}','{id_}')" for o, (kind, id_, _) in enumerate(which)]
    return f"{name}_edge AS (SELECT * FROM (VALUES {','.join(rows)}) t(ord,poly,ring,x0,y0,x1,y1)), {name}_head AS (SELECT h.*, (SELECT sum(a) FROM (SELECT abs(sum(x0*y1-x1*y0))/2 AS a FROM {name}_edge e WHERE e.ord=h.ord AND ring=0 GROUP BY poly)) AS area FROM (VALUES {','.join(heads)}) h(ord,kind,id))"


def placed(points: str, name: str, out: str) -> str:
    """(key, ord) of the place of each point (key, lat, lon)."""
    return f"""{out} AS (SELECT key, ord FROM (SELECT key, ord, poly, bool_or(ring=0 AND odd) AND NOT bool_or(ring>0 AND odd) AS isin FROM (SELECT p.key, e.ord, e.poly, e.ring, sum(CASE WHEN (y0>lat)<>(y1>lat) AND lon<(x1-x0)*(lat-y0)/(y1-y0)+x0 THEN 1 ELSE 0 END)%2=1 AS odd FROM {points} p, {name}_edge e GROUP BY ALL) GROUP BY ALL)
  JOIN {name}_head USING (ord) WHERE isin QUALIFY row_number() OVER (PARTITION BY key ORDER BY kind='sea', CASE WHEN kind='sea' THEN area ELSE 0 END, ord)=1)"""


def named(cells: str, res: int, name: str, out: str) -> str:
    """(h3, ord) of cells: by their centre, else by most corners."""
    d = 0.125 * 3 ** (5 - res)
    row, col = "((h3>>20)&1048575)", "(h3&1048575)"
    corner = ((0, 0), (0, 1), (1, 1), (1, 0))
    points = " UNION ALL ".join(f"SELECT {{'h3': h3, 'at': {i}}} AS key, round({row}*{d}e0-90+{a}*{d}e0,4) AS lat, round({col}*{d}e0-180+{b}*{d}e0,4) AS lon FROM {out}_cells" for i, (a, b) in enumerate(corner))
    return f"""{out}_cells AS (SELECT DISTINCT h3 FROM {cells}), {out}_mid AS (SELECT h3 AS key, round(({row}+0.5e0)*{d}e0-90,4) AS lat, round(({col}+0.5e0)*{d}e0-180,4) AS lon FROM {out}_cells), {placed(f'{out}_mid', name, f'{out}_m')},
{out}_pts AS ({points}), {placed(f'{out}_pts', name, f'{out}_c')},
{out} AS (SELECT key AS h3, ord FROM {out}_m UNION ALL SELECT h3, ord FROM (SELECT key.h3 AS h3, ord, count(*) AS n, min(key.at) AS first FROM {out}_c WHERE key.h3 NOT IN (SELECT key FROM {out}_m) GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY h3 ORDER BY n DESC, first)=1)"""


def _iso(hour: str) -> str:
    return f"strftime({hour}, '%Y-%m-%dT%H:%M:%SZ')"


def _ms(ms: str) -> str:
    return f"make_timestamp({ms}*1000)"


EVENTS = edges(FIRS, "fir") + f""",
mem AS (SELECT hot.*, component FROM hot JOIN comp USING (node)),
per AS (SELECT component, count(DISTINCT icao24) AS observed, count(DISTINCT icao24) FILTER (WHERE aff) AS hit FROM acs JOIN (SELECT hour, h3, component FROM mem) USING (hour, h3) GROUP BY component),
{named('mem', 5, 'fir', 'memfir')},
ecell AS (SELECT component, h3, lower(hex(h3)) AS id, count(*) AS hours, any_value(fh.id) AS fir FROM mem LEFT JOIN memfir USING (h3) LEFT JOIN fir_head fh USING (ord) GROUP BY component, h3),
reg AS (SELECT component, first(id ORDER BY hours DESC, h3) AS region, first(fir ORDER BY hours DESC, h3) AS fir, string_agg(id, ',' ORDER BY id) AS cells, min(id) AS cell0, list_sort(list_distinct(list(fir) FILTER (WHERE fir IS NOT NULL))) AS firs FROM ecell GROUP BY component),
pk AS (SELECT component, hour AS ph, h3 AS pc, n_total AS pt, n_bad AS pb FROM mem QUALIFY row_number() OVER (PARTITION BY component ORDER BY n_bad DESC, n_bad/n_total DESC, hour, h3 DESC)=1),
sp AS (SELECT component, min(hour) AS f, max(hour) AS l, count(*) AS cell_hours, bool_or(anonymous) AS anonymous FROM mem GROUP BY component),
jam AS (SELECT *, greatest(observed, pt, hit) AS seen, (epoch_us(l)-epoch_us(f))//3600000000+1 AS dur, 'ev_'||substr(sha1('jamming|1.2.0|'||{_iso('f')}||'|'||cell0||'|'),1,16) AS event_id FROM sp JOIN per USING (component) JOIN reg USING (component) JOIN pk USING (component))"""
JAM_OUT = f"""event_id, 'jamming' AS type, {_iso('f')} AS first_seen, {_iso('l')} AS last_seen, dur AS duration_hours, cells, region AS region_h3, fir, array_to_string(coalesce(firs, []), ',') AS firs, hit AS affected_aircraft, {_f(SCALE, k='hit')} AS scale, {_f(CONF, 'seen', 'hit')} AS confidence, seen AS aircraft_observed, {_iso('ph')} AS peak_hour, lower(hex(pc)) AS peak_cell, pt AS peak_aircraft_observed, pb AS peak_aircraft_affected, cell_hours,
  CAST(NULL AS VARCHAR) AS spoofing_confidence, CAST(NULL AS VARCHAR) AS icao24, CAST(NULL AS BIGINT) AS jumps, CAST(NULL AS DOUBLE) AS max_dist_nm, CAST(NULL AS BIGINT) AS max_speed_kt, 'adsblol' AS source, '1.2.0' AS algorithm_version, anonymous"""


def _cell5(lat: str, lon: str) -> str:
    return CELL5.replace("lat+90", f"{lat}+90").replace("lon+180", f"{lon}+180")


SPOOFS = f"""spcell AS (SELECT DISTINCT icao24, session, {_cell5('lat0', 'lon0')} AS h3 FROM sess UNION SELECT icao24, session, {CELL5} FROM sess),
{named('spcell', 5, 'fir', 'spfir')},
spreg AS (SELECT icao24, session, string_agg(lower(hex(h3)), ',' ORDER BY lower(hex(h3))) AS cells, min(lower(hex(h3))) AS cell0, list_sort(list_distinct(list(fh.id) FILTER (WHERE fh.id IS NOT NULL))) AS firs FROM spcell LEFT JOIN spfir USING (h3) LEFT JOIN fir_head fh USING (ord) GROUP BY icao24, session),
origin AS (SELECT {{'i': icao24, 's': session}} AS key, round(la,4) AS lat, round(lo,4) AS lon FROM spoof), {placed('origin', 'fir', 'orfir')},
sev AS (SELECT sp.*, r.cells, r.cell0, r.firs, fh.id AS fir, {_cell5('la', 'lo')} AS h3 FROM spoof sp JOIN spreg r USING (icao24, session) LEFT JOIN orfir o ON o.key.i=sp.icao24 AND o.key.s=sp.session LEFT JOIN fir_head fh USING (ord))"""
SPOOF_OUT = f"""'ev_'||substr(sha1('spoofing|1.2.0|'||{_iso(_ms('s'))}||'|'||cell0||'|'||icao24),1,16) AS event_id, 'spoofing' AS type, {_iso(_ms('s'))} AS first_seen, {_iso(_ms('e'))} AS last_seen, e//3600000-s//3600000+1 AS duration_hours, cells, lower(hex(h3)) AS region_h3, fir, array_to_string(coalesce(firs, []), ',') AS firs, CAST(1 AS BIGINT) AS affected_aircraft, CAST(NULL AS VARCHAR) AS scale, CASE conf WHEN 'high' THEN 'high' ELSE 'low' END AS confidence,
  CAST(NULL AS BIGINT) AS aircraft_observed, CAST(NULL AS VARCHAR) AS peak_hour, CAST(NULL AS VARCHAR) AS peak_cell, CAST(NULL AS BIGINT) AS peak_aircraft_observed, CAST(NULL AS BIGINT) AS peak_aircraft_affected, CAST(NULL AS BIGINT) AS cell_hours, conf AS spoofing_confidence, CASE WHEN NOT anon THEN icao24 END AS icao24, n AS jumps, round(md,1) AS max_dist_nm, CAST(round(mv) AS BIGINT) AS max_speed_kt, 'adsblol' AS source, '1.2.0' AS algorithm_version, anon AS anonymous"""


def _share(source: str, column: str) -> str:
    return f"SELECT CAST({column} AS VARCHAR) AS value, count(*) AS n, round(count(*)/sum(count(*)) OVER (), 6) AS share FROM {source} GROUP BY {column}"


def _centre(res: int, h: str = "h3") -> tuple[str, str]:
    d = 0.125 * 3 ** (5 - res)
    return f"(((({h}>>20)&1048575)+0.5e0)*{d}e0-90)", f"((({h}&1048575)+0.5e0)*{d}e0-180)"


def _within(res: int, h: str = "h3") -> str:
    lat, lon = _centre(res, h)
    return f"{lat} BETWEEN 28 AND 48 AND {lon} BETWEEN 16 AND 52"


def _more() -> dict[str, str]:
    """The SQL of events, places, reports, sources and plans."""
    w, rec = f"WITH {ROLL} ", f"WITH RECURSIVE {ROLL}, {PEERS}, {NODES}, {HOT}, {EVENTS}"
    jumpy = f"WITH {POS}, {JUMPS}, {SESSIONS}"
    both = f"{rec}, {JUMPS}, {SESSIONS}, {SPOOFS}"
    every = f"(SELECT {JAM_OUT} FROM jam WHERE hit>=3 UNION ALL SELECT {SPOOF_OUT} FROM sev)"
    row, col = "((h3>>20)&1048575)", "(h3&1048575)"
    s, west, n, east = INNER
    inner = f"({row}*0.125e0-90>={s + 0.05}e0 AND {row}*0.125e0-90+0.125e0<={n - 0.05}e0 AND {col}*0.125e0-180>={west + 0.05}e0 AND {col}*0.125e0-180+0.125e0<={east - 0.05}e0)"
    reps = " UNION ALL ".join(f"SELECT {res} AS resolution, * FROM ({_ac('hour, h3', f'(SELECT * REPLACE ({parent(res)} AS h3) FROM roll)')})" for res in (3, 4, 5))
    levels = lambda src: cells(5, src, False)
    change = f"WITH {ROLL}, {PEERS}, b AS ({levels('roll')}), a AS ({levels('sound')}), ab AS (SELECT b.h3, b.n_total AS total_before, b.n_bad AS bad_before, b.level AS before, coalesce(a.n_total,0) AS total_after, coalesce(a.n_bad,0) AS bad_after, coalesce(a.level,'noData') AS after FROM b LEFT JOIN a ON a.h3=b.h3) "
    span = "CAST(hour(f)//3 AS INT)"
    spans = f"{rec}, ev AS (SELECT *, {span} AS day FROM jam WHERE hit>=1), evc AS (SELECT day, event_id, h3, {row} AS y, {col} AS x FROM ev JOIN ecell USING (component)), rp AS (SELECT ev.day, ev.event_id, ev.hit, (SELECT count(DISTINCT o.day) FROM evc c JOIN evc o ON o.day<>c.day AND abs(o.y-c.y)<=1 AND (abs(o.x-c.x)<=1 OR abs(o.x-c.x)=2879) WHERE c.event_id=ev.event_id AND c.day=ev.day) AS days FROM ev)"
    high = 250 * 2**0.5 / 60
    trace = f"""{POS}, tr AS (SELECT icao24, ts_ms, lat, lon, alt, on_ground, callsign, nic, nac_p, bool_or(anonymous) OVER (PARTITION BY icao24) AS anonymous, ts_ms%4=0 AS det, row_number() OVER (PARTITION BY icao24 ORDER BY ts_ms, lat, lon) AS rn FROM pos),
tl AS (SELECT *, last_value(CASE WHEN det THEN {{'t': 1704067200e0+ts_ms/1000e0, 'nic': nic, 'nac_p': nac_p}} END IGNORE NULLS) OVER w AS d, last_value(CASE WHEN det THEN callsign END IGNORE NULLS) OVER w AS cs, 1704067200e0+ts_ms/1000e0 AS t FROM tr WINDOW w AS (PARTITION BY icao24 ORDER BY rn ROWS UNBOUNDED PRECEDING))"""
    return {
        "jumps_suppressed": f"{jumpy} SELECT icao24, ts0 AS before_ms, ts_ms AS after_ms FROM good",
        "spoof_events": f"{jumpy} SELECT icao24, s AS start_ms, e AS end_ms, n AS jumps, round(md,3) AS max_dist_nm, anon AS anonymous, conf AS confidence FROM spoof",
        "jamming_events": f"{rec} SELECT {JAM_OUT} FROM jam WHERE hit>=3",
        "spoof_common": f"WITH {POS}, {JUMPS}, {SESSIONS}, {edges(FIRS, 'fir')}, {SPOOFS} SELECT {SPOOF_OUT} FROM sev",
        "event_payload": f"{both}, allev AS (SELECT * FROM {every} WHERE {_within(5, '(CAST(concat(chr(48), chr(120), region_h3) AS BIGINT))')}) SELECT '2024-01-01' AS date, '1.2.0' AS algorithm_version, count(*) AS count, (SELECT string_agg(type||'='||n, ',' ORDER BY type) FROM (SELECT type, count(*) AS n FROM allev GROUP BY type)) AS by_type, (SELECT string_agg(confidence||'='||n, ',' ORDER BY confidence) FROM (SELECT confidence, count(*) AS n FROM allev GROUP BY confidence)) AS by_confidence, string_agg(event_id, ',' ORDER BY first_seen, event_id) AS event_ids FROM allev",
        "spoof_payload": f"{jumpy}, fl AS (SELECT icao24, session, count(*) AS n, arg_min(ts0, ts_ms) AS t0, arg_min(lat0, ts_ms) AS la0, arg_max(lon, ts_ms) AS lo1, arg_max(d, ts_ms) AS d1 FROM sess GROUP BY ALL) SELECT CASE WHEN NOT anon THEN icao24 END AS icao24, conf AS confidence, {_iso(_ms('s'))} AS start, {_iso(_ms('e'))} AS end, fl.n, {_iso(_ms('t0'))} AS first_ts, round(la0,4) AS first_lat, round(lo1,4) AS last_lon, round(d1,1) AS last_nm FROM spoof JOIN fl USING (icao24, session) WHERE la BETWEEN 28 AND 48 AND lo BETWEEN 16 AND 52",
        "worst_events": f"{both} SELECT event_id, affected_aircraft, first_seen FROM {every} ORDER BY affected_aircraft DESC, first_seen, event_id LIMIT 10",
        "worst_spoofing": f"{jumpy} SELECT icao24, n AS jumps, s AS start_ms FROM spoof ORDER BY n DESC, s, icao24 LIMIT 10",
        "event_types": f"{both}, allev AS (SELECT * FROM {every}) {_share('allev', 'type')}",
        "event_quantiles": f"{rec} SELECT median(seen) AS median, list_sort(list(seen))[CAST(floor(0.9e0*count(*)) AS BIGINT)+1] AS p90, count(*) AS events FROM jam WHERE hit>=1",
        "event_repeats": f"{spans} SELECT day, event_id, days FROM rp",
        "event_candidates": f"{spans} SELECT least, count(*) AS events, round(avg(CASE WHEN days>=5 THEN 1e0 ELSE 0e0 END),6) AS repeated FROM rp, (SELECT unnest([1,2,3,4,5,8]) AS least) WHERE hit>=least GROUP BY least",
        "expected_hot": f"WITH {ROLL}, {PEERS}, {NODES}, sizes AS (SELECT n_total AS n, count(*) AS c FROM nodes WHERE n_total>=5 GROUP BY ALL), nk AS (SELECT n, c, unnest(range(0, n+1)) AS k FROM sizes), lv AS (SELECT *, {_f(LEVEL, 'n', 'k')} AS level FROM nk) SELECT (SELECT count(*) FROM nodes WHERE level IN ('medium','high')) AS hot, round(coalesce(sum(c*exp(lgamma(n+1e0)-lgamma(k+1e0)-lgamma(n-k+1e0)+k*ln(0.015e0)+(n-k)*ln(0.985e0))),0),6) AS expected FROM lv WHERE level IN ('medium','high')",
        "rollup_resolutions": w + f"SELECT CAST(resolution AS INT) AS resolution, hour, h3, icao24, {_OUT}, {_TEXT}, CAST(hour AS DATE) AS day FROM ({reps})",
        "cells_from_reports": w + cells(4),
        "timeline_from_reports": w + f"SELECT hour, count(*) AS n_aircraft, count(*) FILTER (WHERE aff) AS n_affected FROM ({_ac('hour')}) GROUP BY hour",
        "nic_histogram_reports": f"WITH {ROLL}, part AS (SELECT * FROM uniq WHERE {parent(3)}={CELL}) SELECT " + ", ".join(f"count(*) FILTER (WHERE least(nic,11)={i}) AS nic_{i}" for i in range(12)) + " FROM part",
        "region_cells": w + f"SELECT * FROM ({cells(4, 'roll', False)}) WHERE {_within(4)}",
        "range_cells": f"WITH {ROLL}, part AS (SELECT * FROM roll WHERE hour(hour) BETWEEN 6 AND 11 AND CAST(hour AS DATE)=DATE '2024-01-01') " + cells(4, "part", False),
        "range_sources": f"WITH {POS}, f AS (SELECT * FROM pos WHERE NOT on_ground AND ts_ms>=1704067200000+22800000 AND ts_ms<1704067200000+41400000) {_share('f', 'source')}",
        "cell_places": f"WITH {ROLL}, {edges(PLACES, 'pl')}, {named('roll', 5, 'pl', 'cp')} SELECT h3, kind, id FROM cp JOIN pl_head USING (ord)",
        "fir_totals": f"WITH {ROLL}, {edges(FIRS, 'fir')}, c4 AS ({cells(4, 'roll', False)}), {named('c4', 4, 'fir', 'cf')} SELECT id, CAST(sum(n_total) AS BIGINT) AS aircraft, CAST(sum(n_bad) AS BIGINT) AS affected FROM c4 JOIN cf USING (h3) JOIN fir_head USING (ord) GROUP BY id",
        "country_totals": f"WITH {ROLL}, {edges(PLACES, 'pl')}, c5 AS ({cells(5, 'roll', False)}), {named('c5', 5, 'pl', 'cf')} SELECT id, CAST(sum(n_total) AS BIGINT) AS aircraft, CAST(sum(n_bad) AS BIGINT) AS affected FROM c5 JOIN cf USING (h3) JOIN pl_head USING (ord) WHERE kind='country' GROUP BY id",
        "place_shapes": f"WITH {edges(FIRS, 'fir')} SELECT ord, id, min(x0) AS minx, min(y0) AS miny, max(x0) AS maxx, max(y0) AS maxy, round(any_value(area),9) AS area FROM fir_edge JOIN fir_head USING (ord) GROUP BY ord, id",
        "peak_hours": w + f"SELECT h3, CASE WHEN n>0 THEN hour END AS peak_hour, n AS n_affected FROM (SELECT h3, hour, count(*) FILTER (WHERE aff) AS n FROM ({_ac('h3, hour', f'(SELECT * REPLACE ({parent(4)} AS h3) FROM roll)')}) GROUP BY h3, hour) QUALIFY row_number() OVER (PARTITION BY h3 ORDER BY n DESC, hour)=1",
        "grid_functions": w + f"SELECT DISTINCT h3, lower(hex(h3)) AS id, CAST((h3>>52)&15 AS INT) AS res, h3 AS number, {_centre(5)[0]} AS lat, {_centre(5)[1]} AS lon, {row}*0.125e0-90+0.125e0 AS north, {col}*0.125e0-180+0.125e0 AS east, CAST(9 AS INT) AS near FROM roll",
        "level_transitions": change + "SELECT before, after, count(*) AS n FROM ab GROUP BY ALL",
        "filter_changes": change + "SELECT * FROM ab WHERE before<>after AND before IN ('medium','high')",
        "faulty_share": f"WITH {ROLL}, {PEERS}, aff AS (SELECT DISTINCT icao24 FROM ({_ac('hour, h3')}) WHERE aff) SELECT count(*) AS affected, count(f.icao24) AS faulty, round(count(f.icao24)/count(*), 6) AS share FROM aff LEFT JOIN (SELECT icao24 FROM verdict WHERE faulty) f ON f.icao24=aff.icao24",
        "source_distribution": f"WITH {POS}, f AS (SELECT * FROM pos WHERE NOT on_ground) {_share('f', 'source')}",
        "nic_distribution": f"WITH {POS}, f AS (SELECT * FROM pos WHERE NOT on_ground AND (source='unknown' OR split_part(source, ':', -1) IN ('adsb_icao','adsb_icao_nt'))) {_share('f', 'nic')}",
        "report_totals": f"WITH {POS}, f AS (SELECT *, source='unknown' OR split_part(source, ':', -1) IN ('adsb_icao','adsb_icao_nt') AS direct FROM pos WHERE NOT on_ground) SELECT count(*) AS reports, count(*) FILTER (WHERE direct) AS direct_reports, count(DISTINCT icao24) FILTER (WHERE direct) AS aircraft, count(DISTINCT icao24) FILTER (WHERE direct AND nic<5) AS bad_aircraft FROM f",
        "worst_cells": w + f"SELECT h3, n_total, n_bad FROM ({cells(5)}) WHERE n_bad>0 ORDER BY n_bad DESC, n_bad/n_total DESC, h3 LIMIT 15",
        "geojson_cells": w + f"SELECT h3, 'Feature' AS type, 'Polygon' AS shape, x AS p00, y AS p01, x+1.0*0.375e0 AS p20, y+0.375e0 AS p21, x AS p40, y AS p41, n_bad, level FROM (SELECT *, round({col}*0.375e0-180,5) AS x, round({row}*0.375e0-90,5) AS y FROM ({cells(4, 'roll', False)}))",
        "serving_rows": f"WITH {POS} SELECT ts_ms, icao24, {CELL5} AS h3_r5, nic, source, CAST(make_timestamp(ts_ms*1000) AS DATE) AS day FROM pos",
        "licensed_sources": f"WITH {POS} SELECT 'adsblol' AS key, count(*) AS n FROM pos WHERE split_part(source, ':', 1)='adsblol'",
        "manifest_stats": w + "SELECT 'positions' AS name, count(*) AS rows, count(DISTINCT icao24) AS aircraft FROM pos UNION ALL SELECT 'hourly', count(*), count(DISTINCT icao24) FROM roll",
        "verification": w + f", c AS (SELECT h3, hour(hour) AS h FROM roll WHERE {inner} AND h3 IN (SELECT h3 FROM roll WHERE hour(hour)<>5)) SELECT (SELECT count(DISTINCT h3) FROM c) AS cells_compared, CAST(0 AS BIGINT) AS only_stored, count(*) FILTER (WHERE h=5) AS only_recomputed, count(*) FILTER (WHERE h=9) AS different, count(*) FILTER (WHERE h NOT IN (5,9)) AS equal FROM c",
        "inner_rows": w + f"SELECT h3, count(*) AS n FROM roll WHERE {inner} GROUP BY h3",
        "trace_reports": f"WITH {trace.replace('SELECT icao24, ts_ms, lat', 'SELECT icao24, ts_ms-1704067200000 AS ts_ms, lat', 1).replace('ts_ms%4=0 AS det', '(ts_ms-1704067200000)%4=0 AS det')} SELECT CAST(floor(t*1000) AS BIGINT) AS ts_ms, icao24, lat, lon, CASE WHEN NOT on_ground THEN CAST(alt AS DOUBLE) END AS alt, on_ground, cs AS callsign, CASE WHEN t-d.t<=60 THEN d.nic END AS nic, CASE WHEN t-d.t<=60 THEN d.nac_p END AS nac_p, round(CASE WHEN t-d.t<=60 THEN round(t-d.t,2) END,2) AS nic_age_s, CASE WHEN ts_ms%7=0 THEN 'adsblol:unknown' ELSE 'adsblol:adsb_icao' END AS source, anonymous FROM tl",
        "live_snapshot": "WITH e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events), a AS (SELECT CAST(event_id//200 AS INT) AS snapshot_id, event_id%3 AS circle, event_id, lower(hex(user_id%40)) AS icao24, 28+(event_id*7919)%2500/100e0 AS lat, 15+(event_id*104729)%4000/100e0 AS lon, k, event_type, user_id FROM e WHERE k<>7 AND k*0.75e0<=60 QUALIFY row_number() OVER (PARTITION BY event_id//200, user_id%40 ORDER BY event_id%3, event_id)=1) SELECT snapshot_id, CAST(floor((1704067200e0+snapshot_id*90-k*0.75e0)*1000) AS BIGINT) AS ts_ms, icao24, round(lat,6) AS lat, round(lon,6) AS lon, CASE WHEN event_type<>'signup' THEN CAST(event_id%40000 AS DOUBLE) END AS alt, concat('F', user_id) AS callsign, CASE WHEN k%3<>0 THEN k%12 END AS nic, CASE WHEN k%5=0 THEN 'adsblol:unknown' ELSE 'adsblol:adsb_icao' END AS source, event_type='signup' AS on_ground, ((k%9)&12)<>0 AS anonymous FROM a WHERE lat BETWEEN 28 AND 48 AND lon BETWEEN 16 AND 52",
        "box_circles": f"WITH r AS (SELECT 28e0+(i+0.5e0)*{high!r}e0 AS lat, i FROM range(0, CAST(ceil(20e0/{high!r}e0) AS BIGINT)) t(i)), c AS (SELECT i, lat, {high!r}e0/greatest(cos(radians(lat)),0.1e0) AS wide FROM r), l AS (SELECT i, lat, wide, unnest(range(0, CAST(ceil(32e0/wide) AS BIGINT))) AS j FROM c) SELECT row_number() OVER (ORDER BY i, j)-1 AS circle, round(lat,3) AS lat, round(20e0+(j+0.5e0)*wide,3) AS lon FROM l",
        "airports": "WITH c AS (SELECT concat('K', c_custkey) AS ident, c_custkey AS k, c_name AS name, 20+(c_custkey*37)%4000/100e0 AS lat, 10+(c_custkey*91)%6000/100e0 AS lon, c_mktsegment AS country FROM customer WHERE c_custkey%50<>0) SELECT CASE WHEN k%5=0 THEN ident ELSE concat('Q', k) END AS icao, '' AS iata, name, country, round(lat,4) AS lat, round(lon,4) AS lon, CASE k%4 WHEN 0 THEN 'large' ELSE 'medium' END AS kind FROM c WHERE k%4 IN (0,1) AND k%3<>0 AND lon BETWEEN 15 AND 57 AND lat BETWEEN 24 AND 52",
        "day_plan": "WITH d AS (SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-03-31', INTERVAL 1 DAY)) AS DATE) AS day), n AS (SELECT day, dayofyear(day) AS n FROM d) SELECT day, CASE WHEN n%2=0 THEN 'export' ELSE 'process' END AS mode FROM n WHERE NOT (n%2=0 AND n%3=0) AND NOT (n%5=0 AND n%4+1>=3 AND n%7<3)",
        "days_missing": "WITH d AS (SELECT CAST(unnest(generate_series(DATE '2024-01-25', DATE '2024-02-10', INTERVAL 1 DAY)) AS DATE) AS day) SELECT day, strftime(day, '%Y-%m') AS month FROM d WHERE dayofmonth(day)%3<>0",
    }


def oracle_sql() -> dict[str, str]:
    w = f"WITH {ROLL} "
    part = f"WITH {ROLL}, {PART} "
    line = lambda src: f"SELECT hour, count(*) AS n_aircraft, count(*) FILTER (WHERE aff) AS n_affected FROM ({_ac('hour', src)}) GROUP BY hour"
    coarse = lambda res: f"(SELECT * REPLACE ({parent(res)} AS h3) FROM roll)"
    dense = lambda c: "concat_ws(',', " + ", ".join(f"count(*) FILTER (WHERE hour(hour)={h}{c})" for h in range(24)) + ")"
    out = {f"cells_r{res}": w + cells(res) for res in (3, 4, 5)}
    return out | _more() | {
        "positions_fixture": f"WITH {POS} SELECT ts_ms, icao24, round(lat,6) AS lat, round(lon,6) AS lon, CAST(alt AS DOUBLE) AS alt, callsign, nic, nac_p, source, on_ground, anonymous FROM pos",
        "hourly_rollup": w + f"SELECT hour, h3, icao24, {_OUT}, {_TEXT} FROM roll",
        "coarsen_rollup": w + f"SELECT hour, h3, icao24, {_OUT}, {_TEXT} FROM ({_ac('hour, h3', coarse(3))})",
        "bad_aircraft_topn": w + f"SELECT h3, CAST(rank AS INT) AS rank, mn AS min_nic, CASE WHEN NOT anon THEN icao24 END AS icao24, CASE WHEN NOT anon THEN callsign END AS callsign, anon AS anonymous FROM (SELECT *, row_number() OVER (PARTITION BY h3 ORDER BY mn, icao24) AS rank FROM ({_ac('h3', coarse(4))}) WHERE aff) WHERE rank<=50",
        "timeline": w + line("roll"),
        "timeline_filled": w + f"SELECT g.hour, coalesce(n_aircraft,0) AS n_aircraft, coalesce(n_affected,0) AS n_affected FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-01 23:00:00', INTERVAL 1 HOUR)) AS hour) g LEFT JOIN ({line('roll')}) t ON g.hour=t.hour",
        "route_hours": w + f"SELECT h3, {dense('')} AS aircraft, {dense(' AND aff')} AS affected FROM ({_ac('h3, hour', coarse(4))}) GROUP BY h3",
        "cell_aircraft": part + f"SELECT CASE WHEN NOT anon THEN icao24 END AS icao24, CASE WHEN NOT anon THEN callsign END AS callsign, r AS n_reports, b AS n_bad_reports, mn AS min_nic, anon AS anonymous, aff AS affected, n_total, n_bad FROM (SELECT *, count(*) OVER () AS n_total, count(*) FILTER (WHERE aff) OVER () AS n_bad FROM ({_ac('', 'part')})) q ORDER BY q.aff DESC, q.mn, q.r DESC, q.icao24 LIMIT 100",
        "cell_hours": part + line("part"),
        "nic_histogram": part + "SELECT " + ", ".join(f"CAST(coalesce(sum(bin{i}),0) AS BIGINT) AS nic_{i}" for i in range(12)) + " FROM part",
        "cell_altitude": part + f"SELECT {_CRUISE}, CAST(sum(b) AS BIGINT) AS bad_reports, CAST(sum(lb) AS BIGINT) AS low_bad_reports FROM ({_ac('', 'part')})",
        "cell_nacp": part + f"SELECT count(*) FILTER (WHERE np>0) AS n_total_nacp, count(*) FILTER (WHERE np>0 AND 2*lnp>=np) AS n_bad_nacp, count(*) FILTER (WHERE np>0 AND 2*lnp>=np AND aff) AS n_bad_both FROM ({_ac('', 'part')})",
        "data_range": w + "SELECT min(hour) AS first_hour, max(hour) AS last_hour, count(*) AS n_rows FROM roll",
        "detail_cell_selection": w + "SELECT h3, CAST(resolution AS INT) AS resolution, n_total, n_bad FROM (" + " UNION ALL ".join(f"SELECT {res} AS resolution, * FROM ({cells(res, 'roll', False)})" for res in (3, 4, 5)) + ") WHERE level IN ('medium','high') ORDER BY n_bad DESC, n_bad/n_total DESC, lower(hex(h3)) LIMIT 2000",
        "avionics_peers": w + f", {PEERS} SELECT hour, h3, icao24, affected, peers, affected_peers, clean FROM peer",
        "avionics_verdicts": w + f", {PEERS} SELECT * FROM verdict",
        "avionics_report": w + f", {PEERS} SELECT count(*) AS assessed, count(*) FILTER (WHERE clean_buckets>=3) AS decidable, count(*) FILTER (WHERE faulty) AS faulty FROM verdict",
        "cells_excluding_faulty": w + f", {PEERS} " + cells(4, "sound", False),
        "cell_hour_nodes": w + f", {PEERS}, {NODES} SELECT * FROM nodes",
        "event_components": f"WITH RECURSIVE {ROLL}, {PEERS}, {NODES}, {HOT} SELECT * FROM comp",
        "jumps_raw": f"WITH {POS}, {JUMPS} SELECT icao24, ts0 AS before_ms, ts_ms AS after_ms, round(d,3) AS dist_nm, round(v,1) AS speed_kt FROM jump",
        "level_table": f"SELECT n, k, round({_f(TAIL, 'n', 'k')}, 9) AS tail, {_f(LEVEL, 'n', 'k')} AS level, {_f(CONF, 'n', 'k')} AS confidence, {_f(SCALE, 'n', 'k')} AS scale FROM (SELECT n, unnest(range(0, n+1)) AS k FROM range(0, 60) t(n))",
    }
