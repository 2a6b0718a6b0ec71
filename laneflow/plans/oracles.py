"""The same queries as SQL, for DuckDB on the same tables."""

from __future__ import annotations

from laneflow.config import REPORT_SPEEDS

_CAMERA = "case when user_id%7=3 then 'Side_Road' when (user_id//2)%2=0 then 'IC_Papagou' else 'Roupaki_Toll_Station' end"

_TRAFFIC = f"""
traffic as (
  select event_id, 'V'||user_id as vehicle_id,
         case when event_id%41=0 then null
              else case event_type when 'purchase' then 'truck' when 'click' then 'car' when 'view' then 'car'
                                   when 'signup' then 'motorcycle' else 'bus' end end as vehicle_type,
         case when event_id%50=0 then null else value end as speed_kmh,
         case when user_id%2=0 then 'inbound' else 'outbound' end as carriageway,
         {_CAMERA} as segment,
         (epoch_us(ts)-1704067200000000)/1e6 as timestamp_s,
         case when event_id%3=0 then 'displacement' else 'tripwire' end as speed_source
  from events),
measured as (
  select *, trunc(timestamp_s)::bigint as sec, (trunc(timestamp_s)::bigint//300)::int + 1 as window_index
  from traffic where speed_kmh is not null)
"""


def _json(speed: str) -> str:
    """Message text of a row, built by hand."""
    def text(name: str) -> str:
        return f"""'"{name}":' || coalesce('"' || {name} || '"', 'null')"""
    number = f"coalesce({speed}::varchar, 'null')"
    return " || ',' || ".join([
        "'{' || " + text("vehicle_id"), text("vehicle_type"), f"""'"speed_kmh":' || {number}""",
        text("carriageway"), text("segment"),
        """'"timestamp_s":' || """ + _JAVA_SECONDS, text("speed_source"),
    ]) + " || '}'"


# Java writes a double of 1e7 or more, and one below 1e-3, with an exponent; the feed spans 30 days = 2.6e6 s.
_JAVA_SECONDS = "printf('%.2f', timestamp_s)::double::varchar"

_TWO_DIGITS = "printf('%.2f', speed_kmh)::double"

_ALERTS = _TRAFFIC + """,
sent as (
  select *, case when event_id%97=0 then 'text' when event_id%89=0 then 'array' when event_id%83=0 then 'word'
                 when event_id%79=0 then 'bare' when event_id%73=0 then 'short' else 'whole' end as form
  from traffic),
alerts as (
  select event_id,
         case when form='whole' then segment else '?' end as camera_name,
         case when form='bare' then 'UNKNOWN' else vehicle_id end as vehicle_id,
         case when form='whole' then coalesce(vehicle_type,'vehicle') else 'vehicle' end as vehicle_type,
         case when form='bare' then 150.5::double else speed_kmh end as speed_kmh,
         case when form='whole' then carriageway else '?' end as direction
  from sent where form in ('bare','short','whole')
    and case when form='bare' then 150.5::double else coalesce(speed_kmh,0::double) end >= 130),
numbered as (select *, row_number() over (order by event_id) as alert_no from alerts)
"""

_CAMERAS = """
cameras as (
  select * from (values
    ('IC_Papagou',640,590,80,690,1200,28.0::double,16.0::double,'to_Katechaki','to_Mesogeia_Vrilissia'),
    ('Roupaki_Toll_Station',640,570,60,710,1210,30.0::double,15.0::double,'to_Elefsina','to_Athens_Airport'))
    t(camera_name,split,l1,l2,r1,r2,dist_m,px_per_m,left_label,right_label))
"""

_SIZE = "case when (20+(event_id*7)%140)*(20+(event_id*11)%100)>=9000 then 'truck' else 'car' end"

_POSITIONS = f"""
sightings as (
  select {_CAMERA} as camera_name, case when user_id%2=0 then 'L' else 'R' end as side, user_id as track_id,
         event_id as frame_id, (floor(value*4)::int)%1280 as cx, ((event_id*37)%720)::int as cy,
         false as coasting, {_SIZE} as vehicle_type
  from events)
"""

_DENSE = f"""
positions as (
  select case when event_id%16%2=0 then 'IC_Papagou' else 'Roupaki_Toll_Station' end as camera_name,
         case when (event_id%16)//2%2=0 then 'L' else 'R' end as side,
         event_id%16 + 16*(event_id//16//512) as track_id, event_id//16 as frame_id,
         (floor(value*4)::int)%1280 as cx, ((event_id*37)%720)::int as cy, false as coasting,
         {_SIZE} as vehicle_type
  from events)
"""
_SPARSE = _POSITIONS + ", positions as (select * from sightings)"

_TRACKS = """,
calibrated as (
  select p.*, case when side='L' then coalesce(l1,580) else coalesce(r1,700) end as first_line,
         case when side='L' then coalesce(l2,100) else coalesce(r2,1180) end as second_line,
         coalesce(dist_m,28.0::double) as dist_m, coalesce(px_per_m,16.0::double) as px_per_m,
         case when side='L' then coalesce(left_label,'left_lane') else coalesce(right_label,'right_lane') end as direction
  from positions p left join cameras using (camera_name)),
stepped as (
  select *, lag(cx) over w as previous, first_value(cx) over h as oldest, count(*) over h as n
  from calibrated
  window w as (partition by camera_name, side, track_id order by frame_id),
         h as (partition by camera_name, side, track_id order by frame_id rows between 9 preceding and current row)),
crossed as (
  select *, coalesce((previous<first_line and first_line<=cx) or (cx<first_line and first_line<=previous), false)
              as crossed_1,
         coalesce((previous<second_line and second_line<=cx) or (cx<second_line and second_line<=previous), false)
              as crossed_2,
         case when n>=8 then abs(cx-oldest)::double/(n-1)::double/px_per_m*25.0::double*3.6::double end as raw_kmh,
         case when n<4 then 'unknown' when cx-oldest>10 then 'right' when cx-oldest<-10 then 'left'
              else 'unknown' end as movement
  from stepped),
begun as (
  select camera_name, side, track_id, min(frame_id) as first_frame
  from crossed where crossed_1 group by camera_name, side, track_id),
lapped as (
  select camera_name, side, track_id, first_frame, min(frame_id) as second_frame
  from crossed join begun using (camera_name, side, track_id)
  where crossed_2 and frame_id>first_frame group by camera_name, side, track_id, first_frame),
tripwire as (
  select l.*, dist_m/((second_frame-first_frame)/25.0::double)*3.6::double as speed_kmh,
         c.movement, c.vehicle_type, c.direction
  from lapped l join crossed c using (camera_name, side, track_id) where c.frame_id=l.second_frame),
displaced as (select * from crossed where raw_kmh>5 and raw_kmh<200),
estimates as (
  select camera_name, side, track_id, second_frame as frame_id, 0 as rank, speed_kmh, 'tripwire' as speed_source,
         first_frame/25.0::double as timestamp_s, movement, vehicle_type, direction
  from tripwire
  union all
  select camera_name, side, track_id, frame_id, 1, raw_kmh, 'displacement', 0::double, movement, vehicle_type,
         direction
  from displaced)
"""


def _resolved(order: str) -> str:
    return f""",
resolved as (
  select * exclude (nth) from (
    select *, row_number() over (partition by camera_name, side, track_id order by {order}) as nth from estimates)
  where nth=1)
"""


_RESOLVED = _resolved("frame_id, rank")
_RESOLVED_COLUMNS = """
  select camera_name, side, track_id, side||track_id as vehicle_id, vehicle_type, round(speed_kmh,6) as speed_kmh,
         direction, movement, speed_source, round(timestamp_s,6) as timestamp_s, frame_id
  from resolved"""

_TRACK_SQL = f"with {_CAMERAS}, {_SPARSE} {_TRACKS}"
_DENSE_SQL = f"with {_CAMERAS}, {_DENSE} {_TRACKS}"

_SHOTS = """,
shots as (
  select camera_name, unnest(range(125, last+1, 125)) as frame_id
  from (select camera_name, max(frame_id) as last from positions group by camera_name))
"""

_BOXES = f"""
boxes as (
  select {_CAMERA} as camera_name, event_id, user_id,
         ((event_id*37)%1200)::int as x, ((event_id*53)%640)::int as y,
         (20+(event_id*7)%140)::int as w, (20+(event_id*11)%100)::int as h,
         [2,3,5,7,0,1][event_id%6+1] as class_id
  from events)
"""
_CLASS = "case class_id when 2 then 'car' when 3 then 'motorcycle' when 5 then 'bus' when 7 then 'truck' end"

_CLEAN = _BOXES + """,
clean as (
  select b.camera_name, event_id//16 as frame_id, (event_id%16)::int as box_id, x, y, w, h, class_id,
         x+w//2 as cx, y+h//2 as cy, case when x+w//2<coalesce(split,640) then 'L' else 'R' end as side
  from boxes b left join cameras using (camera_name)
  where 0.8::double*w*h>=1500)
"""

# The tracker, frame by frame over all camera sides: lists of tracks as the state of a recursive query. A frame's pairs
# within the distance are sorted by distance, track and box, and folded: a pair is taken if neither its track nor its box is.
_WALK = _CLEAN + """,
feeds as (select camera_name, side, min(frame_id) as begins, max(frame_id) as ends from clean group by camera_name, side),
framed as (
  select camera_name, side, frame_id, list({'x': cx::bigint, 'y': cy::bigint} order by box_id) as boxes
  from clean group by camera_name, side, frame_id),
walk as (
  select camera_name, side, ends, begins - 1 as frame_id, [{'id': 0::bigint, 'x': 0::bigint, 'y': 0::bigint, 'lost': 0}][:0] as tracks, 0::bigint as next
  from feeds
  union all
  select camera_name, side, ends, frame_id,
         list_concat(
           list_filter(list_transform(range(1, len(tracks) + 1), lambda t: case when list_contains(taken.t, t) then
               {'id': tracks[t].id, 'x': boxes[taken.b[list_position(taken.t, t)]].x, 'y': boxes[taken.b[list_position(taken.t, t)]].y, 'lost': 0}
               else {'id': tracks[t].id, 'x': tracks[t].x, 'y': tracks[t].y, 'lost': tracks[t].lost + 1} end), lambda k: k.lost <= 12),
           list_transform(range(1, len(fresh) + 1), lambda n: {'id': next + n - 1, 'x': boxes[fresh[n]].x, 'y': boxes[fresh[n]].y, 'lost': 0})) as tracks,
         next + len(fresh) as next
  from (
    select *, list_filter(range(1, len(boxes) + 1), lambda b: not list_contains(taken.b, b)) as fresh
    from (
      select *, list_reduce(
          list_prepend({'t': []::bigint[], 'b': []::bigint[]}, list_transform(list_sort(list_filter(flatten(
            list_transform(range(1, len(tracks) + 1), lambda t: list_transform(range(1, len(boxes) + 1), lambda b:
              {'d': (tracks[t].x - boxes[b].x) * (tracks[t].x - boxes[b].x) + (tracks[t].y - boxes[b].y) * (tracks[t].y - boxes[b].y), 't': t, 'b': b}))),
            lambda p: p.d <= 180 * 180)), lambda p: {'t': [p.t], 'b': [p.b]})),
          lambda kept, p: case when list_contains(kept.t, p.t[1]) or list_contains(kept.b, p.b[1]) then kept
                               else {'t': list_concat(kept.t, p.t), 'b': list_concat(kept.b, p.b)} end) as taken
      from (
        select w.camera_name, w.side, w.ends, w.frame_id + 1 as frame_id, w.tracks, w.next, coalesce(f.boxes, []) as boxes
        from walk w left join framed f on f.camera_name = w.camera_name and f.side = w.side and f.frame_id = w.frame_id + 1
        where w.frame_id < w.ends)))),
tracked as (
  select camera_name, side, k.id as track_id, frame_id, k.x::int as cx, k.y::int as cy, k.lost > 0 as coasting
  from (select camera_name, side, frame_id, unnest(tracks) as k from walk))
"""

_LIVE_SQL = f"with recursive {_CAMERAS}, {_WALK}" + """,
nearest as (
  select p.camera_name, p.side, p.track_id, p.frame_id, p.cx, p.cy, p.coasting,
         arg_min(case when c.w*c.h>=9000 then 'truck' else 'car' end, (abs(p.cx-c.cx)+abs(p.cy-c.cy))*16+c.box_id) as class
  from tracked p left join clean c using (camera_name, frame_id, side) group by all),
positions as (
  select camera_name, side, track_id, frame_id, cx, cy, coasting,
         last_value(class ignore nulls) over (partition by camera_name, side, track_id order by frame_id
           rows between unbounded preceding and current row) as vehicle_type
  from nearest)
""" + _TRACKS + _RESOLVED

_EACH_ONCE = f"{_LIVE_SQL} select distinct camera_name, side||track_id as vehicle_id, 1::bigint as events from resolved"

# The homography, row by row: fixed values.
_H = ("-0.07278562259306805::double", "-0.08446726572528884::double", "60.58279845956355::double",
      "0.0::double", "-0.8118100128369705::double", "239.48395378690634::double",
      "0.0::double", "-0.006033376123234916::double", "1.0::double")


def _bev(x: str, y: str) -> tuple[str, str]:
    a, b, c, d, e, f, g, h, i = _H
    scale = f"({g}*{x}+{h}*{y}+{i})"
    return f"({a}*{x}+{b}*{y}+{c})/{scale}", f"({d}*{x}+{e}*{y}+{f})/{scale}"


_LINE_1, _LINE_2 = _bev("640.0::double", "400.0::double")[1], _bev("640.0::double", "560.0::double")[1]
_CORRECTED = f"abs({_LINE_2} - {_LINE_1})"
_NAIVE = "(160.0::double*25.0::double/840.0::double)"
_BEV_X, _BEV_Y = _bev("foot_x", "foot_y")

_FEET = _BOXES + f""",
feet as (
  select camera_name, user_id as track_id, event_id as frame_id, class_id, {_CLASS} as vehicle_type,
         x+w/2.0::double as foot_x, (y+h)::double as foot_y
  from boxes where class_id in (2,3,5,7)),
placed as (select *, {_BEV_X} as bev_x, {_BEV_Y} as bev_y from feet)
"""

_ROAD = f"with {_FEET}" + f""",
stepped as (
  select *, lag(foot_y) over w as previous, first_value(bev_y) over h as oldest, count(*) over h as n
  from placed
  window w as (partition by camera_name, track_id order by frame_id),
         h as (partition by camera_name, track_id order by frame_id rows between 24 preceding and current row)),
crossed as (
  select *, coalesce((previous<=400 and 400<foot_y) or (foot_y<=400 and 400<previous), false) as crossed_1,
         coalesce((previous<=560 and 560<foot_y) or (foot_y<=560 and 560<previous), false) as crossed_2
  from stepped),
begun as (
  select camera_name, track_id, min(frame_id) as first_frame from crossed where crossed_1
  group by camera_name, track_id),
lapped as (
  select camera_name, track_id, first_frame, min(frame_id) as second_frame
  from crossed join begun using (camera_name, track_id)
  where crossed_2 and frame_id>first_frame group by camera_name, track_id, first_frame),
tripwire as (
  select *, {_CORRECTED}/((second_frame-first_frame)/25.0::double)*3.6::double as corrected_kmh,
         {_NAIVE}/((second_frame-first_frame)/25.0::double)*3.6::double as naive_kmh
  from lapped),
samples as (
  select c.*, abs(bev_y-oldest)/(n/25.0::double)*3.6::double as bev_kmh
  from crossed c left join lapped l using (camera_name, track_id)
  where n>12.5 and (second_frame is null or frame_id<second_frame)),
report as (
  select ids.camera_name, ids.track_id as vehicle_id, k.vehicle_type,
         t.corrected_kmh as tripwire_speed_corrected_kmh, t.naive_kmh as tripwire_speed_naive_kmh,
         b.mean as bev_avg_speed_kmh, b.low as bev_min_speed_kmh, b.high as bev_max_speed_kmh
  from (select camera_name, track_id from tripwire union select camera_name, track_id from samples) ids
  join (select camera_name, track_id, arg_max(vehicle_type, frame_id) as vehicle_type from placed
        group by camera_name, track_id) k using (camera_name, track_id)
  left join tripwire t using (camera_name, track_id)
  left join (select camera_name, track_id, avg(bev_kmh) as mean, min(bev_kmh) as low, max(bev_kmh) as high
             from samples group by camera_name, track_id) b using (camera_name, track_id))
"""

_ORDINAL = """case when {n}%100 between 11 and 13 then 'th' when {n}%10=1 then 'st' when {n}%10=2 then 'nd'
                   when {n}%10=3 then 'rd' else 'th' end"""
_Q6 = f"""
  with {_TRAFFIC}, mean as (
    select carriageway, window_index, round(avg(speed_kmh),0)::int as avg_speed_kmh
    from measured group by carriageway, window_index)
"""
# Windows that a stream with a 5-minute watermark has given out by the end of the feed.
_CLOSED = "window_index*300 <= (select max(sec) from measured) - 300"
_VIOLATION = "((vehicle_type='truck' and speed_kmh>80) or (vehicle_type<>'truck' and speed_kmh>90))"

ORACLES: dict[str, str] = {
    "decode_events": f"""
        with {_TRAFFIC}, sent as (
          select * replace (printf('%.2f', speed_kmh)::double as speed_kmh, printf('%.2f', timestamp_s)::double as timestamp_s) from traffic)
        select event_id, vehicle_id, vehicle_type, speed_kmh, carriageway, segment, timestamp_s, speed_source,
               make_timestamp(trunc(timestamp_s)::bigint*1000000) as event_time
        from sent where speed_kmh is not null""",
    "encode_events": f"with {_TRAFFIC} select event_id, {_json(_TWO_DIGITS)} as value from traffic",
    "route_events": f"""
        with {_TRAFFIC}
        select event_id, unnest(case when speed_kmh>130 then ['traffic-stats','traffic-alerts']
                                     else ['traffic-stats'] end) as topic,
               {_json(_TWO_DIGITS)} as value
        from measured""",
    "event_time": f"""
        with {_TRAFFIC}
        select event_id, make_timestamp(trunc(timestamp_s)::bigint*1000000) as event_time from traffic""",
    "ordinal": f"select event_id, event_id || {_ORDINAL.format(n='event_id')} as ordinal from events",
    "q1_vehicle_speeds": f"""
        with {_TRAFFIC}
        select event_id, vehicle_id, carriageway, vehicle_type, speed_kmh, speed_source, segment from measured""",
    "q2_vehicles_per_lane": f"""
        with {_TRAFFIC}
        select carriageway, count(distinct vehicle_id) as vehicle_count from measured group by carriageway""",
    "q2_approx": f"with {_TRAFFIC} select distinct carriageway, true as close from measured",
    "stream_q2": f"with {_TRAFFIC} select distinct carriageway, true as close from measured",
    "q5_approx": f"with {_TRAFFIC} select distinct carriageway, window_index, true as close from measured",
    "q3_speed_violations": f"""
        with {_TRAFFIC}
        select carriageway, vehicle_type, count(*) as violation_count from measured
        where {_VIOLATION} group by carriageway, vehicle_type""",
    "q3_total": f"with {_TRAFFIC} select count(*) as violation_count from measured where {_VIOLATION}",
    "q4_speed_alerts": f"with {_ALERTS} select * from alerts",
    "malformed_alerts": f"""
        with {_ALERTS}
        select event_id,
               case form when 'text' then 'not json' when 'array' then '[1, 2]'
                    else '{{"vehicle_id":"'||vehicle_id||'","speed_kmh":"abc"}}' end as value,
               case form when 'word' then 'speed is not a number' else 'not a JSON object' end as reason
        from sent where form in ('text','array','word')""",
    "alert_numbering": f"with {_ALERTS} select * from numbered",
    "alert_log": f"""
        with {_ALERTS}
        select event_id, alert_no,
               printf('⚠  SPEED ALERT #%d  |  cam=%-15s  %s %s  |  %.1f km/h  |  lane: %s',
                      alert_no, camera_name, upper(vehicle_type), vehicle_id, speed_kmh, direction) as log_line,
               printf('⚠  SPEED ALERT  |  cam=%-20s  %s %s  |  %.1f km/h  |  %s',
                      camera_name, upper(vehicle_type), vehicle_id, speed_kmh, direction) as tracker_line
        from numbered""",
    "alert_total": f"with {_ALERTS} select count(*) as alert_count from alerts",
    "q5_vehicles_per_window": f"""
        with {_TRAFFIC}
        select carriageway, count(distinct vehicle_id) as vehicle_count,
               make_timestamp((window_index-1)::bigint*300000000) as window_start, window_index
        from measured group by carriageway, window_index""",
    "q6_avg_speed": f"{_Q6} select carriageway, avg_speed_kmh, window_index from mean",
    "q6_log": f"""{_Q6}
        select '('||carriageway||', '||window_index||{_ORDINAL.format(n='window_index')}||' 5min, '
               ||avg_speed_kmh||'kmh)' as log_entry, carriageway, window_index, avg_speed_kmh
        from mean""",
    "positions_calibrated": f"{_TRACK_SQL} select * from calibrated",
    "tripwire_crossings": f"""{_TRACK_SQL}
        select camera_name, side, track_id, frame_id, previous, cx as current, crossed_1, crossed_2
        from crossed where crossed_1 or crossed_2""",
    "tripwire_crossings_y": f"""{_ROAD}
        select camera_name, track_id, frame_id, previous, foot_y as current, crossed_1, crossed_2
        from crossed where crossed_1 or crossed_2""",
    "tripwire_speeds": f"""{_TRACK_SQL}
        select camera_name, side, track_id, first_frame, second_frame, round(speed_kmh,6) as speed_kmh
        from tripwire""",
    "tripwire_speeds_y": f"""{_ROAD}
        select camera_name, track_id, first_frame, second_frame, round(corrected_kmh,6) as corrected_kmh,
               round(naive_kmh,6) as naive_kmh
        from tripwire""",
    "displacement_speeds": f"""{_TRACK_SQL}
        select camera_name, side, track_id, frame_id, n as history_rows, round(raw_kmh,6) as speed_kmh
        from displaced""",
    "movement": f"{_TRACK_SQL} select camera_name, side, track_id, frame_id, movement from crossed",
    "resolved_events": f"{_TRACK_SQL} {_RESOLVED} {_RESOLVED_COLUMNS}",
    "resolved_prefer_tripwire": f"{_TRACK_SQL} {_resolved('rank, frame_id')} {_RESOLVED_COLUMNS}",
    "first_seen": f"""{_TRACK_SQL}
        select camera_name, side, track_id, min(frame_id) as frame_id, any_value(direction) as direction
        from calibrated group by camera_name, side, track_id""",
    "activity_snapshot": f"""{_DENSE_SQL} {_RESOLVED} {_SHOTS}
        select s.camera_name, s.frame_id,
               (select count(*) from positions p where p.camera_name=s.camera_name and p.frame_id=s.frame_id
                  and side='L') as active_left,
               (select count(*) from positions p where p.camera_name=s.camera_name and p.frame_id=s.frame_id
                  and side='R') as active_right,
               (select count(*) from resolved r where r.camera_name=s.camera_name and r.frame_id<=s.frame_id)
                  as events_saved
        from shots s""",
    "snapshot_speed_list": f"""{_DENSE_SQL} {_SHOTS}, sided as (
          select camera_name, side, frame_id from shots, (values ('L'), ('R')) v(side))
        select s.camera_name, s.side, s.frame_id,
               coalesce((select string_agg(printf('%s%d=%.0f', side, track_id, speed_kmh), '  '
                                           order by second_frame, track_id)
                         from tripwire t where t.camera_name=s.camera_name and t.side=s.side
                           and t.second_frame<=s.frame_id and t.second_frame>s.frame_id-125), '—') as new_speeds,
               (select count(*) from tripwire t where t.camera_name=s.camera_name and t.side=s.side
                  and t.second_frame<=s.frame_id) as speeds_so_far
        from sided s""",
    "snapshot_speeds_at": f"""{_DENSE_SQL} {_SHOTS}, sided as (
          select camera_name, side, frame_id from shots, (values ('L'), ('R')) v(side))
        select s.camera_name, s.side, s.frame_id,
               coalesce((select string_agg(printf('%s%d=%.0f', side, track_id, speed_kmh), '  '
                                           order by second_frame, track_id)
                         from tripwire t where t.camera_name=s.camera_name and t.side=s.side
                           and t.second_frame<=s.frame_id), '—') as speeds
        from sided s
        where bit_count((s.frame_id//125)::bigint)=1
           or s.frame_id=(select max(frame_id) from sided m where m.camera_name=s.camera_name)""",
    "session_totals": f"""{_TRACK_SQL} {_RESOLVED}
        select camera_name, max(frame_id) as frames_processed,
               (select count(*) from resolved r where r.camera_name=p.camera_name) as events_saved
        from positions p group by camera_name""",
    "class_filter": f"with {_FEET} select camera_name, track_id, frame_id, class_id, vehicle_type from placed",
    "bev_positions": f"""with {_FEET}
        select frame_id, track_id, foot_x, foot_y, round(bev_x,6) as bev_x, round(bev_y,6) as bev_y from placed""",
    "bev_speeds": f"{_ROAD} select camera_name, track_id, frame_id, round(bev_kmh,6) as bev_kmh from samples",
    "position_labels": f"""{_ROAD}
        select c.camera_name, c.track_id, c.frame_id,
               upper(c.vehicle_type)||' #'||c.track_id||
               case when c.frame_id>=t.second_frame then '  '||trunc(t.corrected_kmh)::int||' km/h'
                    when s.bev_kmh is not null then '  ~'||trunc(s.bev_kmh)::int||' km/h' else '' end as label
        from crossed c left join tripwire t using (camera_name, track_id)
        left join samples s using (camera_name, track_id, frame_id)""",
    "zone_occupancy": f"""with {_BOXES},
        seen as (
          select camera_name, event_id//16 as frame_id, count_if(class_id in (2,3,5,7) and y+h between 370 and 590)::bigint as shown,
                 count_if(class_id in (2,3,5,7) and y+h between 400 and 560)::bigint as in_zone
          from boxes group by camera_name, event_id//16),
        following as (select *, lead(frame_id) over (partition by camera_name order by frame_id) as next from seen),
        axis as (
          select camera_name, shown, in_zone, frame_id as own,
                 unnest(generate_series(frame_id, case when next-frame_id<=90000 then next-1 else frame_id end)) as frame_id
          from following)
        select camera_name, frame_id, case when frame_id=own then shown else 0 end as shown,
               case when frame_id=own then in_zone else 0 end as in_zone
        from axis""",
    "vehicle_report": f"""{_ROAD}
        select camera_name, vehicle_id, vehicle_type,
               {', '.join(f'round({c},6) as {c}' for c in REPORT_SPEEDS)}
        from report order by vehicle_id, camera_name""",
    "vehicle_report_text": f"""{_ROAD}
        select camera_name, vehicle_id, vehicle_type,
               {', '.join(f"coalesce(printf('%.1f', round({c},6)), '') as {c}" for c in REPORT_SPEEDS)}
        from report""",
    "run_summary": f"""{_ROAD}
        select count(tripwire_speed_corrected_kmh) as tripwire_vehicles, count(bev_avg_speed_kmh) as bev_vehicles,
               round(avg(tripwire_speed_corrected_kmh),6) as mean_corrected_kmh,
               round(avg(tripwire_speed_naive_kmh),6) as mean_naive_kmh,
               round((avg(tripwire_speed_corrected_kmh)/avg(tripwire_speed_naive_kmh)-1)*100,6) as effect_pct
        from report""",
    "measured_vehicle_ids": f"""{_ROAD}
        select camera_name, track_id from tripwire union select camera_name, track_id from samples""",
    "detections_clean": f"""with {_CAMERAS}, {_CLEAN}
        select camera_name, frame_id, box_id, x, y, w, h, class_id, cx, cy, side from clean""",
    "vehicle_class": f"""with {_CAMERAS}, {_CLEAN}, positions as (
          select camera_name, case when x+w//2<640 then 'L' else 'R' end as side,
                 event_id%16 + 16*((event_id//16)//512) as track_id, event_id//16 as frame_id,
                 x+w//2+case when (event_id//16+event_id%16)%5=0 then w%7 else 0 end as cx,
                 y+h//2+case when (event_id//16+event_id%16)%5=0 then h%11 else 0 end as cy
          from boxes),
        nearest as (
          select p.camera_name, p.side, p.track_id, p.frame_id,
                 arg_min(case when c.w*c.h>=9000 then 'truck' else 'car' end,
                         (abs(p.cx-c.cx)+abs(p.cy-c.cy))*16+c.box_id) as class
          from positions p left join clean c using (camera_name, frame_id, side)
          group by p.camera_name, p.side, p.track_id, p.frame_id)
        select camera_name, side, track_id, frame_id,
               last_value(class ignore nulls) over (partition by camera_name, side, track_id order by frame_id
                 rows between unbounded preceding and current row) as vehicle_type
        from nearest""",
    "assign_tracks": f"with recursive {_CAMERAS}, {_WALK} select * from tracked",
    "stream_tracks": f"with recursive {_CAMERAS}, {_WALK} select * from tracked",
    "live_events": f"{_LIVE_SQL} {_RESOLVED_COLUMNS}",
    "stream_live": f"""{_LIVE_SQL}
        select camera_name, side||track_id as vehicle_id, vehicle_type,
               printf('%.2f', speed_kmh)::double as speed_kmh, direction, movement, speed_source
        from resolved""",
    "tracked_boxes": f"with {_CAMERAS}, {_CLEAN} select camera_name, side, frame_id, cx, cy from clean",
    "vehicles_with_events": _EACH_ONCE,
    "stream_tracked_boxes": f"with {_CAMERAS}, {_CLEAN} select camera_name, side, frame_id, cx, cy from clean",
    "stream_vehicles": _EACH_ONCE,
    "match_candidates": f"""with {_CAMERAS}, {_CLEAN}
        select * from (
          select a.camera_name, a.side, a.frame_id, a.box_id as box_before, b.box_id as box_after,
                 round(sqrt((a.cx-b.cx)::double*(a.cx-b.cx)+(a.cy-b.cy)::double*(a.cy-b.cy)),6) as distance_px
          from clean a join clean b
            on a.camera_name=b.camera_name and a.side=b.side and b.frame_id=a.frame_id+1)
        where distance_px<=180""",
    "stream_q1": f"""
        with {_TRAFFIC}
        select vehicle_id, carriageway, vehicle_type, speed_kmh, speed_source, segment from measured""",
    "stream_q3": f"""
        with {_TRAFFIC}
        select carriageway, vehicle_type, count(*) as violation_count from measured
        where {_VIOLATION} group by carriageway, vehicle_type""",
    "stream_q4": f"""
        with {_ALERTS}
        select camera_name, vehicle_id, vehicle_type, printf('%.2f', speed_kmh)::double as speed_kmh, direction
        from alerts""",
    "stream_malformed": f"""
        with {_ALERTS}
        select case form when 'text' then 'not json' when 'array' then '[1, 2]'
                    else '{{"vehicle_id":"'||vehicle_id||'","speed_kmh":"abc"}}' end as value,
               case form when 'word' then 'speed is not a number' else 'not a JSON object' end as reason
        from sent where form in ('text','array','word')""",
    "stream_q5": f"""
        with {_TRAFFIC}
        select carriageway, count(distinct vehicle_id) as vehicle_count,
               make_timestamp((window_index-1)::bigint*300000000) as window_start, window_index
        from measured where {_CLOSED} group by carriageway, window_index""",
    "stream_q6": f"""{_Q6}
        select '('||carriageway||', '||window_index||{_ORDINAL.format(n='window_index')}||' 5min, '
               ||avg_speed_kmh||'kmh)' as log_entry, carriageway, window_index, avg_speed_kmh
        from mean where {_CLOSED}""",
    "stream_resolved": f"""{_TRACK_SQL} {_RESOLVED}
        select camera_name, side||track_id as vehicle_id, vehicle_type,
               printf('%.2f', speed_kmh)::double as speed_kmh, direction, movement, speed_source
        from resolved""",
    "segment_plan": """
        with videos as (
          select 'Downloads/clip.v1_'||doc_id||'.mp4' as video_name, 'clip.v1_'||doc_id as base,
                 n_chars/10.0::double as duration_s
          from documents)
        select video_name, ceil(duration_s/120)::bigint as total_segments, i+1 as segment_no,
               i*120.0::double as start_s, least((i+1)*120.0::double, duration_s) as end_s,
               base||'_part_'||(i+1)||'.mp4' as segment_name
        from (select *, unnest(range(0, ceil(duration_s/120)::bigint)) as i from videos
              where duration_s>0)""",
    "segment_plan_first": """
        with videos as (
          select 'Downloads/clip.v1_'||doc_id||'.mp4' as video_name, 'clip.v1_'||doc_id as base,
                 n_chars/10.0::double as duration_s
          from documents)
        select video_name, ceil(duration_s/120)::bigint as total_segments, i+1 as segment_no,
               i*120.0::double as start_s, least((i+1)*120.0::double, duration_s) as end_s,
               base||'_part_'||(i+1)||'.mp4' as segment_name
        from (select *, unnest(range(0, least(ceil(duration_s/120)::bigint, 3))) as i from videos
              where duration_s>0)""",
    "segment_assign": f"""
        with {_TRAFFIC}
        select event_id, segment, timestamp_s, floor(timestamp_s/120)::bigint+1 as segment_no,
               floor(timestamp_s/120)*120.0::double as segment_start_s,
               (floor(timestamp_s/120)+1)*120.0::double as segment_end_s
        from traffic""",
}
