"""Reference answers in plain SQL (DuckDB dialect) over the driver's tables.

Written independently of the Spark code: every query re-derives its inputs from
the base tables (region nation customer supplier part orders lineitem events)
with CTEs and computes the same result with joins, window functions and
aggregates. Row numbers order NULLS FIRST, as Spark's ascending sort does.
"""

from __future__ import annotations

RUN = "date '2000-01-01'"          # reseller file run date
LATE = "date '1999-12-31'"         # date of the late files
REPROCESS = "date '2002-01-01'"
DAY = "date '1998-03-02'"
DAY_ID = 19980302
WEB_DAY = "timestamp '2024-01-15'"


def did(d: str) -> str:
    return f"cast(year({d})*10000 + month({d})*100 + day({d}) as integer)"


class Q:
    """An ordered set of named CTEs."""

    def __init__(self):
        self.ctes: dict[str, str] = {}

    def add(self, name: str, body: str) -> str:
        if name not in self.ctes:
            self.ctes[name] = body
        return name

    def sql(self, final: str) -> str:
        if not self.ctes:
            return final
        return "WITH " + ",\n".join(f"{n} AS (\n{b}\n)" for n, b in self.ctes.items()) + "\n" + final


def latest(src: str, keys: list[str], order: list[str], rest: list[str], cols: str = "*") -> str:
    """One row per key: greatest by order then rest, NULL lowest."""
    ob = ", ".join(f"{c} DESC NULLS LAST" for c in order + rest)
    return (f"select {cols} from {src} qualify row_number() over "
            f"(partition by {', '.join(keys)} order by {ob}) = 1")


# ------------------------------------------------------------------ stand-ins

ENTITY_COLS = {
    "f_customer": ["CustId", "FirstName", "LastName", "Pmail", "PhoneNo", "CreateDate", "UpdateDate"],
    "f_event": ["EventId", "VenueId", "LocId", "EventName", "EventType", "TicketCost", "CreateDate",
                "UpdateDate", "StartDate", "EndDate"],
    "f_location": ["LocId", "LocName", "StAddress", "City", "Province", "Region", "CreateDate", "UpdateDate",
                   "Country", "PstCd"],
    "f_reseller": ["ResellerId", "FirstName", "LastName", "CreateDate", "UpdateDate"],
    "f_venue": ["VenueId", "VenueName", "CreateDate", "UpdateDate"],
    "f_commission": ["EvResId", "EvntId", "ResId", "Commission", "CreateDate", "UpdateDate"],
    "f_platform_transaction": ["TransId", "CustId", "EventId", "Channel", "CreateDate", "UpdateDate",
                               "TicketsCnt", "Amount", "delFlag", "Reseller_id"],
}
ENTITY_KEYS = {"f_customer": ["CustId"], "f_event": ["EventId"], "f_location": ["LocId"],
               "f_reseller": ["ResellerId"], "f_venue": ["VenueId"], "f_commission": ["EvntId", "ResId"],
               "f_platform_transaction": ["TransId"]}


def base(q: Q, name: str) -> str:
    if name == "f_customer":
        return q.add(name, """select c_custkey CustId, substr(c_name,1,8) FirstName, substr(c_name,10) LastName,
  cast(null as varchar) Pmail, cast(null as varchar) PhoneNo,
  date '1995-01-01' + cast(c_custkey % 365 as integer) CreateDate,
  case when c_custkey % 4 = 0 then date '1996-01-01' + cast(c_custkey % 365 as integer) end UpdateDate
from customer""")
    if name == "f_location":
        return q.add(name, """select n_nationkey LocId, n_name LocName, cast(null as varchar) StAddress, n_name City,
  r_name Province, cast(r_regionkey as double) Region, date '1995-01-01' CreateDate,
  case when n_nationkey % 3 = 0 then date '1996-03-01' + cast(n_nationkey as integer) end UpdateDate,
  n_name Country, cast(null as varchar) PstCd
from nation join region on n_regionkey = r_regionkey""")
    if name == "f_venue":
        return q.add(name, """select VenueId, VenueName, date '1995-01-01' CreateDate,
  case when VenueId % 4 = 0 then date '1996-04-01' + VenueId end UpdateDate
from (select distinct cast(substr(p_brand,7) as integer) VenueId, p_brand VenueName from part) v""")
    if name == "f_event":
        return q.add(name, """select p_partkey EventId, cast(substr(p_brand,7) as integer) VenueId,
  cast(p_partkey % 25 as integer) LocId, 'Event#' || cast(p_partkey as varchar) EventName,
  p_type EventType, p_retailprice TicketCost,
  date '1995-01-01' + cast(p_partkey % 365 as integer) CreateDate,
  case when p_partkey % 5 = 0 then date '1996-01-01' + cast(p_partkey % 365 as integer) end UpdateDate,
  date '1996-06-01' + cast(p_partkey % 365 as integer) StartDate,
  case when p_partkey % 10 <> 0 then date '1996-07-01' + cast(p_partkey % 365 as integer) end EndDate
from part""")
    if name == "f_reseller":
        return q.add(name, """select s_suppkey ResellerId, substr(s_name,1,8) FirstName, substr(s_name,10) LastName,
  date '1995-01-01' CreateDate,
  case when s_suppkey % 3 = 0 then date '1996-02-01' + cast(s_suppkey % 365 as integer) end UpdateDate
from supplier""")
    if name == "f_commission":
        return q.add(name, """select EvntId*1000000 + ResId EvResId, EvntId, ResId, Commission,
  date '1995-01-01' CreateDate, cast(null as date) UpdateDate
from (select l_partkey EvntId, l_suppkey ResId, max(l_discount) Commission from lineitem group by 1, 2) c""")
    if name == "f_sale":
        return q.add(name, """select l_orderkey*10 + l_linenumber TransId, l_returnflag feed, o_custkey CustId,
  l_partkey EventId, l_suppkey,
  case when l_orderkey % 50 = 0 then 'Unknown event' else 'Event#' || cast(l_partkey as varchar) end eventName,
  case when l_orderkey % 40 = 0 then 'Nowhere' else n_name end officeLoc,
  case when l_orderkey % 60 = 0 then cast(-1 as bigint) when l_partkey % 7 = 0 then null else l_suppkey end reseller_id,
  o_orderpriority channel, cast(trunc(l_quantity) as integer) tickets,
  case when l_linenumber % 5 = 0 then l_extendedprice
       else cast(trunc(l_quantity) as integer) * p_retailprice end amount,
  cast(o_orderdate as date) createDate,
  case when l_linestatus = 'F' then cast(l_shipdate as date) end updateDate,
  case when l_orderkey % 97 = 0 then 'Y' else 'N' end delFlag
from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
  join nation on l_partkey % 25 = n_nationkey""")
    if name == "f_platform_transaction":
        base(q, "f_sale")
        return q.add(name, """select TransId, CustId, EventId, channel Channel, createDate CreateDate,
  updateDate UpdateDate, tickets TicketsCnt, amount Amount, delFlag, reseller_id Reseller_id
from f_sale where feed = 'N'""")
    if name == "f_file_sale":
        base(q, "f_sale")
        base(q, "f_customer")
        return q.add(name, """select s.*, c.FirstName, c.LastName from f_sale s join f_customer c on s.CustId = c.CustId""")
    if name == "csv_feed":
        base(q, "f_file_sale")
        q.add("csv_file_day", f"""select *, coalesce(reseller_id, l_suppkey) file_res,
  case when abs(coalesce(reseller_id, l_suppkey)) % 10 = 9 then {LATE} else {RUN} end file_day
from f_file_sale where feed = 'A'""")
        return q.add(name, """select cast(TransId as bigint) transID, eventName, tickets Purchased_ticket, amount Amount,
  channel, FirstName custFirstName, LastName custLastName, officeLoc, createDate,
  'DailySales_' || strftime(file_day, '%m%d') || '0' || strftime(file_day, '%y') || '_'
    || cast(file_res as varchar) || '.csv' source_file
from csv_file_day""")
    if name == "xml_feed":
        base(q, "f_file_sale")
        return q.add(name, """select cast(TransId as bigint) transID, eventName, tickets Purchased_ticket, amount Amount,
  channel, FirstName custFirstName, LastName custLastName, officeLoc, createDate,
  cast(reseller_id as varchar) reseller_id
from f_file_sale where feed = 'R'""")
    if name == "cal":
        return q.add(name, f"""select {did('d')} date_dim_id, d date_actual from (
  select cast(unnest(generate_series(cast((select min(o_orderdate) from orders) as timestamp),
                                     cast((select max(l_shipdate) from lineitem) as timestamp),
                                     interval 1 day)) as date) d) g""")
    if name == "weblog":
        return q.add(name, """select concat_ws('.', cast(10 + (user_id*7) % 210 as varchar), cast((user_id*31) % 256 as varchar),
    cast((user_id*17) % 256 as varchar), cast(user_id % 256 as varchar)) client_ip,
  '-' user_identity, 'Customer#' || lpad(cast(user_id as varchar), 9, '0') user_name, ts request_date,
  case when event_type = 'purchase' then 'POST' else 'GET' end request_type,
  '/' || event_type || '/' || cast(event_id as varchar) request,
  case when event_type = 'error' then '500' else '200' end status,
  cast(trunc(value * 100) as bigint) response_size, '-' referer,
  (['Firefox', 'Chrome', 'Safari', 'Edge'])[cast(event_id % 4 + 1 as integer)] user_agent,
  user_id, event_id
from events""")
    if name == "geo":
        return q.add(name, """select octet * 16777216 ip_start,
  octet * 16777216 + cast(pow(2, 32 - plen) as bigint) - 1 ip_end, n_name country_name
from (select n_nationkey, n_name, 10 + n_nationkey*8 + j octet, case when j = 7 then 9 else 8 end plen
      from nation cross join range(8) t(j)) b""")
    if name == "web_customer":
        return q.add(name, """select c_custkey cust_document_no, c_name customer_name,
  cast(date '1960-01-01' + cast(c_custkey % 10000 as integer) as timestamp) date_of_birth,
  timestamp '2024-01-01' + to_days(cast(c_custkey % 31 as integer)) + to_hours(cast(c_custkey % 24 as integer)) created_at
from customer""")
    if name == "company":
        return q.add(name, """select c_custkey cuit_identifier, c_name company_name, c_mktsegment company_type,
  timestamp '2024-01-01' + to_days(cast((c_custkey + 7) % 31 as integer)) + to_hours(cast(c_custkey % 24 as integer)) created_at
from customer""")
    if name in ("seller_products", "supplier_products"):
        cond = "p_size <= 25" if name == "seller_products" else "p_size > 25"
        return q.add(name, f"""select p_partkey prod_id,
  timestamp '2024-01-01' + to_days(cast(p_partkey % 31 as integer)) + to_hours(cast(p_partkey % 24 as integer)) created_at
from part where {cond}""")
    if name == "web_order":
        return q.add(name, """select ts created_at, event_id order_id, user_id customer_id,
  case when user_id % 3 = 0 then 'Company' else 'Customer' end end_user_type,
  case when user_id % 2 = 0 then 'Seller' else 'Supplier' end order_src_type
from events where event_type = 'purchase'""")
    if name == "order_item":
        return q.add(name, """select l_orderkey order_id, l_orderkey*10 + l_linenumber order_item_id, l_partkey item_id,
  cast(trunc(l_quantity) as bigint) quantity, l_extendedprice total_paid from lineitem""")
    raise KeyError(name)


def versions(q: Q, ent: str) -> str:
    """Staged change versions of an entity: as created, and as updated."""
    base(q, ent)
    cols = ENTITY_COLS[ent]
    first = ", ".join("cast(null as date) UpdateDate" if c == "UpdateDate" else c for c in cols)
    allc = ", ".join(cols)
    return q.add(f"st_{ent}", f"""select *, {did('load_date')} BatchId from (
  select {first}, CreateDate load_date from {ent}
  union all
  select {allc}, UpdateDate load_date from {ent} where UpdateDate is not null) v""")


def current(q: Q, ent: str) -> str:
    st = versions(q, ent)
    keys = ENTITY_KEYS[ent]
    rest = [c for c in ENTITY_COLS[ent] if c not in keys and c not in ("UpdateDate", "CreateDate")] + ["BatchId"]
    cols = ", ".join(ENTITY_COLS[ent])
    return q.add(f"cur_{ent}", latest(st, keys, ["UpdateDate", "CreateDate"], rest, cols))


# ------------------------------------------------------------------ dimensions

DIMS = {
    # name: (entity, key, dwh key, {dwh: src}, set cols, update join, extra roles)
    "customer": ("f_customer", "CustId", "Src_cust_id",
                 {"Src_cust_id": "CustId", "Fname": "FirstName", "Lname": "LastName", "Pmail": "Pmail",
                  "PhoneNo": "PhoneNo"},
                 ["Fname", "Lname", "Pmail", "PhoneNo", "UpdateDt_id"], "join", {}),
    "venue": ("f_venue", "VenueId", "src_Venue_id", {"src_Venue_id": "VenueId", "venue_name": "VenueName"},
              ["venue_name", "UpdateDt_id"], "left join", {}),
    "reseller": ("f_reseller", "ResellerId", "src_res_id",
                 {"src_res_id": "ResellerId", "fName": "FirstName", "lName": "LastName"},
                 ["fName", "lName", "UpdateDt_id"], "left join", {}),
    "location": ("f_location", "LocId", "src_loc_id",
                 {"src_loc_id": "LocId", "Loc_name": "LocName", "StAddress": "StAddress", "City": "City",
                  "Province": "Province", "Region": "Region", "Country": "Country", "PstCd": "PstCd"},
                 ["UpdateDt_id", "Loc_name"], "left join", {}),
    "event": ("f_event", "EventId", "src_event_id",
              {"src_event_id": "EventId", "event_name": "EventName", "event_type": "EventType",
               "ticket_cost": "TicketCost", "LocId": "LocKey", "Venue_id": "VenueKey"},
              ["UpdateDt_id", "startDt_id", "endDt_id", "event_name"], "join",
              {"StartDate": "startDt_id", "EndDate": "endDt_id"}),
}


def dim(q: Q, name: str) -> str:
    ent, key, dkey, cmap, set_cols, upd_join, extra = DIMS[name]
    st = versions(q, ent)
    cal = base(q, "cal")
    if name == "event":
        dim(q, "location")
        dim(q, "venue")
    rest = [c for c in ENTITY_COLS[ent] if c not in (key, "UpdateDate", "CreateDate")] + ["BatchId"]
    pd = q.add(f"pd_{name}", latest(st, [key, "load_date"], ["UpdateDate", "CreateDate"], rest))
    roles = {"UpdateDate": "UpdateDt_id", **extra}

    def enrich(where: str, update_join: str) -> str:
        joins = [f"join {cal} c0 on v.CreateDate = c0.date_actual"]
        sel = ["c0.date_dim_id createDt_id"]
        for i, (dcol, out) in enumerate(roles.items(), start=1):
            how = update_join if dcol == "UpdateDate" else "left join"
            joins.append(f"{how} {cal} c{i} on v.{dcol} = c{i}.date_actual")
            sel.append(f"c{i}.date_dim_id {out}")
        src_cols = [f"v.{s} {d}" for d, s in cmap.items() if s not in ("LocKey", "VenueKey")]
        if name == "event":
            joins.append("left join dim_location lk on lk.src_loc_id = v.LocId")
            joins.append("left join dim_venue vk on vk.src_Venue_id = v.VenueId")
            src_cols += ["lk.row_wid LocId", "vk.row_wid Venue_id"]
        return (f"select {', '.join(src_cols + sel)}, v.load_date from {pd} v "
                + " ".join(joins) + f" where {where}")

    ins = q.add(f"ins_{name}", enrich("v.UpdateDate is null or v.CreateDate = v.load_date", "left join"))
    upd = q.add(f"upd_{name}", enrich("v.UpdateDate is not null", upd_join))
    out_cols = list(cmap) + ["createDt_id", "UpdateDt_id"] + list(extra.values())
    keyed = q.add(f"keyed_{name}", f"""select row_number() over (order by load_date NULLS FIRST, {dkey} NULLS FIRST) row_wid,
  {', '.join(out_cols)} from {ins}""")
    urest = [c for c in out_cols if c != dkey]
    updl = q.add(f"updl_{name}", latest(upd, [dkey], ["load_date"], urest))
    sel = ", ".join(f"case when u.{dkey} is not null then u.{c} else k.{c} end {c}" if c in set_cols else f"k.{c}"
                    for c in out_cols)
    return q.add(f"dim_{name}", f"""select k.row_wid, {sel} from {keyed} k left join {updl} u on k.{dkey} = u.{dkey}""")


# ------------------------------------------------------------------ facts

def fact_platform(q: Q, unknown_member: bool = True) -> str:
    st = versions(q, "f_platform_transaction")
    cal = base(q, "cal")
    for d in ("event", "customer", "venue", "location", "reseller"):
        dim(q, d)
    com = current(q, "f_commission")
    rest = ["CustId", "EventId", "Channel", "TicketsCnt", "Amount", "delFlag", "Reseller_id", "BatchId"]
    pd = q.add("pd_tx", latest(st, ["TransId", "load_date"], ["UpdateDate", "CreateDate"], rest))
    how = "left join" if unknown_member else "join"
    tag = "um" if unknown_member else "in"

    def enrich(where):
        return f"""select v.TransId src_trans_id, c.date_dim_id createDt_id, u.date_dim_id UpdateDt_id,
  e.row_wid event_id, vn.row_wid venue_id, cu.row_wid customer_id, coalesce(r.row_wid, 1) reseller_id,
  'platfrom' sold_by, v.TicketsCnt tickets_sold, v.Amount total_amount, v.delFlag del_flg, v.BatchId,
  l.row_wid OfficeLocId, v.Channel, coalesce(m.Commission, 0) commission, v.load_date
from {pd} v join {cal} c on v.CreateDate = c.date_actual left join {cal} u on v.UpdateDate = u.date_actual
  join dim_event e on v.EventId = e.src_event_id
  join dim_customer cu on v.CustId = cu.Src_cust_id
  join dim_venue vn on e.Venue_id = vn.row_wid
  join dim_location l on e.LocId = l.row_wid
  {how} {com} m on e.src_event_id = m.EvntId and v.Reseller_id = m.ResId
  {how} dim_reseller r on v.Reseller_id = r.src_res_id
where {where}"""
    ins = q.add(f"txins_{tag}", enrich("v.UpdateDate is null or v.CreateDate = v.load_date"))
    upd = q.add(f"txupd_{tag}", enrich("v.UpdateDate is not null"))
    cols = ["createDt_id", "UpdateDt_id", "event_id", "venue_id", "customer_id", "reseller_id", "sold_by",
            "tickets_sold", "total_amount", "del_flg", "BatchId", "OfficeLocId", "Channel", "commission"]
    updl = q.add(f"txupdl_{tag}", latest(upd, ["src_trans_id"], ["load_date"], cols))
    sel = ", ".join(f"case when u.src_trans_id is not null then u.{c} else k.{c} end {c}"
                    if c in ("UpdateDt_id", "del_flg") else f"k.{c}" for c in cols)
    return q.add(f"fact_platform_{tag}", f"""select k.src_trans_id, {sel} from {ins} k
  left join {updl} u on k.src_trans_id = u.src_trans_id and k.sold_by = 'platfrom'""")


def flags(q: Q, feed: str, run: str, with_reseller: bool, src: str | None = None) -> str:
    ev = current(q, "f_event")
    loc = current(q, "f_location")
    src = src or feed
    name = f"flags_{src}_{run.split(chr(39))[1].replace('-', '')}"
    res_join = res_flag = ""
    if with_reseller:
        res = current(q, "f_reseller")
        res_join = f"left join (select distinct ResellerId from {res}) r on r.ResellerId = cast(f.reseller_id as bigint)"
        res_flag = "case when r.ResellerId is not null then 1 else 0 end reseller_ok,"
    return q.add(name, f"""select f.*,
  case when e.EventName is not null then 1 else 0 end event_ok,
  case when l.LocName is not null then 1 else 0 end location_ok,
  {res_flag}
  case when f.Amount = f.Purchased_ticket * e.TicketCost then 1 else 0 end valid_ticket,
  case when f.createDate between e.CreateDate and {run} then 1 else 0 end valid_date
from {src} f
  left join (select EventName, TicketCost, CreateDate from {ev}
             qualify row_number() over (partition by EventName order by CreateDate desc nulls last,
                                        TicketCost desc nulls last) = 1) e on f.eventName = e.EventName
  left join (select distinct LocName from {loc}) l on f.officeLoc = l.LocName
  {res_join}""")


def quarantine_sql(q: Q, fl: str, run: str, with_reseller: bool) -> str:
    rules = [("event_ok", "invalid_event"), ("location_ok", "invalid_location")]
    if with_reseller:
        rules.append(("reseller_ok", "invalid_reseller"))
    rules += [("valid_ticket", "invalid_ticket_amount"), ("valid_date", "invalid_date")]
    parts = [f"select transID, '{msg}' comment, 'N' reprocessed, {run} createDt, cast(null as date) updateDt "
             f"from {fl} where {c} = 0" for c, msg in rules]
    return "\nunion all\n".join(parts)


FEED9 = ["transID", "eventName", "Purchased_ticket", "Amount", "channel", "custFirstName", "custLastName",
         "officeLoc", "createDate"]


def valid(fl: str, extra: list[str], with_reseller: bool) -> str:
    cond = "event_ok = 1 and location_ok = 1 and valid_ticket = 1 and valid_date = 1"
    if with_reseller:
        cond += " and reseller_ok = 1"
    return f"select {', '.join(FEED9 + extra)} from {fl} where {cond}"


def staged_file(q: Q, kind: str) -> str:
    if kind == "csv":
        fl = flags(q, base(q, "csv_feed"), RUN, False)
        res = "cast(regexp_extract(source_file, 'DailySales_\\d{2}\\d{2}\\d\\d{2}_(-?\\d+)\\.csv', 1) as bigint)"
        v = valid(fl, ["source_file"], False)
    else:
        fl = flags(q, base(q, "xml_feed"), RUN, True)
        res = "cast(reseller_id as bigint)"
        v = valid(fl, ["reseller_id"], True)
    return q.add(f"staged_{kind}", f"""select {', '.join(FEED9)}, {res} Reseller_id, {RUN} load_date,
  {did(RUN)} BatchId from ({v}) x""")


def fact_file(q: Q, kind: str) -> str:
    st = staged_file(q, kind)
    cal = base(q, "cal")
    for d in ("event", "customer", "venue", "location", "reseller"):
        dim(q, d)
    com = current(q, "f_commission")
    rest = FEED9[1:] + ["Reseller_id", "BatchId"]
    one = q.add(f"one_{kind}", latest(st, ["transID"], ["load_date"], rest))
    sold = "Csv_3rdparthy_platfrom" if kind == "csv" else "Xml_3rdparty_platfrom"
    return q.add(f"fact_{kind}", f"""select cast(v.transID as bigint) src_trans_id, c.date_dim_id createDt_id,
  cast(null as integer) UpdateDt_id, e.row_wid event_id, vn.row_wid venue_id, cu.row_wid customer_id,
  r.row_wid reseller_id, '{sold}' sold_by, v.Purchased_ticket tickets_sold, v.Amount total_amount,
  'N' del_flg, v.BatchId, l.row_wid OfficeLocId, v.channel Channel, m.Commission commission
from {one} v join {cal} c on v.createDate = c.date_actual
  join dim_event e on v.eventName = e.event_name
  join dim_customer cu on v.custFirstName = cu.Fname and v.custLastName = cu.Lname
  join dim_venue vn on e.Venue_id = vn.row_wid
  join dim_location l on v.officeLoc = l.Loc_name
  join {com} m on e.src_event_id = m.EvntId and v.Reseller_id = m.ResId
  join dim_reseller r on v.Reseller_id = r.src_res_id""")


FACT_COLS = ["src_trans_id", "createDt_id", "UpdateDt_id", "event_id", "venue_id", "customer_id", "reseller_id",
             "sold_by", "tickets_sold", "total_amount", "del_flg", "BatchId", "OfficeLocId", "Channel", "commission"]


def fact_all(q: Q) -> str:
    p = fact_platform(q)
    c = fact_file(q, "csv")
    x = fact_file(q, "xml")
    cols = ", ".join(FACT_COLS)
    return q.add("fact_all", f"select {cols} from {p} union all select {cols} from {c} union all select {cols} from {x}")


# ------------------------------------------------------------------ web-order mart

def ip_long(col: str) -> str:
    parts = [f"cast(split_part({col}, '.', {i}) as bigint)" for i in range(1, 5)]
    return f"({parts[0]}*16777216 + {parts[1]}*65536 + {parts[2]}*256 + {parts[3]})"


def request_country(q: Q) -> str:
    w = base(q, "weblog")
    g = base(q, "geo")
    return q.add("req_country", f"""select w.*, g.country_name from {w} w
  left join {g} g on {ip_long('w.client_ip')} between g.ip_start and g.ip_end""")


KEY_FMT = "'%Y-%m-%d %H:%M:%S.%f'"


def order_requests(q: Q) -> str:
    rc = request_country(q)
    return q.add("mart_order_request", f"""select row_number() over (order by request_date NULLS FIRST, request NULLS FIRST) req_key,
  user_name || strftime(request_date, {KEY_FMT}) req_src_id, user_agent browser, country_name country from {rc}""")


def mart_customers(q: Q) -> str:
    c = base(q, "web_customer")
    return q.add("mart_customers", f"""select row_number() over (order by cast(created_at as date) NULLS FIRST,
    cust_document_no NULLS FIRST) customer_key,
  cust_document_no cuit_identifier, customer_name, date_of_birth customer_DOB from {c}""")


def mart_companies(q: Q) -> str:
    c = base(q, "company")
    return q.add("mart_company", f"""select row_number() over (order by cast(created_at as date) NULLS FIRST,
    cuit_identifier NULLS FIRST) company_key,
  cuit_identifier company_src_identifier, company_name, company_type from {c}""")


def products(q: Q) -> str:
    s = base(q, "seller_products")
    p = base(q, "supplier_products")
    return q.add("mart_products", f"""select row_number() over (order by d NULLS FIRST, r NULLS FIRST, product_src_id NULLS FIRST) product_key,
  product_src_id, product_src_type from (
  select cast(created_at as date) d, 0 r, prod_id product_src_id, 'Supplier' product_src_type from {p}
  union all
  select cast(created_at as date) d, 1 r, prod_id product_src_id, 'Seller' product_src_type from {s}) x""")


def order_lines(q: Q) -> str:
    o = base(q, "web_order")
    i = base(q, "order_item")
    c = base(q, "web_customer")
    cp = base(q, "company")
    sp = base(q, "supplier_products")
    slp = base(q, "seller_products")
    return q.add("order_lines", f"""select o.*, i.order_item_id, i.item_id, i.quantity, i.total_paid,
  c.customer_name c_name, cp.company_name cp_name, sp.prod_id sp_prod_id, slp.prod_id slp_prod_id
from {o} o join {i} i on o.order_id = i.order_id
  left join {c} c on o.customer_id = c.cust_document_no and o.order_src_type = 'Seller'
  left join {cp} cp on o.customer_id = cp.cuit_identifier and o.order_src_type = 'Supplier'
  left join {sp} sp on i.item_id = sp.prod_id and o.order_src_type = 'Supplier'
  left join {slp} slp on i.item_id = slp.prod_id and o.order_src_type = 'Seller'""")


def order_fact(q: Q) -> str:
    ol = order_lines(q)
    p = products(q)
    cu = mart_customers(q)
    co = mart_companies(q)
    rq = order_requests(q)
    rows = q.add("order_rows", f"""select l.created_at order_date, p.product_key, l.end_user_type,
  case when l.end_user_type = 'Customer' then cu.customer_key else co.company_key end end_user_key,
  rq.req_key order_request_key, l.order_id order_src_id, l.order_item_id order_item_src_id,
  l.quantity line_item_qty, l.total_paid line_paid_amt
from {ol} l
  left join {p} p on p.product_src_id = coalesce(l.sp_prod_id, l.slp_prod_id)
  left join {cu} cu on cu.cuit_identifier = l.customer_id
  left join {co} co on co.company_src_identifier = l.customer_id
  left join {rq} rq on rq.req_src_id = coalesce(l.c_name, l.cp_name) || strftime(l.created_at, {KEY_FMT})""")
    order = ["order_date", "order_src_id", "order_item_src_id", "product_key", "end_user_type", "end_user_key",
             "order_request_key", "line_item_qty", "line_paid_amt"]
    ob = ", ".join(f"{c} NULLS FIRST" for c in order)
    return f"select row_number() over (order by {ob}) order_key, * from {rows}"


# ------------------------------------------------------------------ the queries

def _sql() -> dict[str, str]:
    out: dict[str, str] = {}

    q = Q()
    pt = base(q, "f_platform_transaction")
    out["incremental_pull"] = q.sql(f"select * from {pt} where CreateDate = {DAY} or UpdateDate = {DAY}")
    out["incremental_count"] = q.sql(f"select count(*) cnt from {pt} where CreateDate = {DAY} or UpdateDate = {DAY}")

    q = Q()
    out["csv_sales_scan"] = q.sql(f"select * from {base(q, 'csv_feed')}")

    q = Q()
    f = base(q, "f_file_sale")
    out["xml_sales_scan"] = q.sql(f"""select cast(TransId as bigint) tranactionId, eventName,
  tickets numberOfPurchasedTickets, amount totalAmount, channel salesChannel, officeLoc officeLocation,
  createDate dateCreated, '2000-01-01' transaction_date, cast(reseller_id as varchar) transaction_reseller_id,
  FirstName customer_first_name, LastName customer_last_name from {f} where feed = 'R'""")

    q = Q()
    w = base(q, "weblog")
    out["weblog_scan"] = q.sql(f"select * exclude (user_id, event_id) from {w}")

    q = Q()
    st = versions(q, "f_platform_transaction")
    out["staged_window_scan"] = q.sql(
        f"select * from {st} where load_date = {DAY} and (CreateDate = {DAY} or UpdateDate = {DAY})")

    q = Q()
    out["current_lookup"] = q.sql(f"select * from {current(q, 'f_event')}")

    q = Q()
    out["calendar_dim"] = q.sql(f"select * from {base(q, 'cal')}")

    q = Q()
    out["staging_append_roundtrip"] = q.sql(f"select * from {versions(q, 'f_customer')}")

    q = Q()
    out["warehouse_append"] = q.sql(f"select * from {dim(q, 'reseller')}")

    def resync(q):
        c = current(q, "f_customer")
        return q.add("resync", f"""select CustId Src_cust_id, FirstName Fname, LastName Lname, Pmail, PhoneNo,
  {did('CreateDate')} createDt_id, {did('UpdateDate')} UpdateDt_id from {c}""")

    cust_cols = ["row_wid", "Src_cust_id", "Fname", "Lname", "Pmail", "PhoneNo", "createDt_id", "UpdateDt_id"]
    cust_set = ["Fname", "Lname", "Pmail", "PhoneNo", "UpdateDt_id"]
    upd_sel = ", ".join(f"case when r.Src_cust_id is not null then r.{c} else d.{c} end {c}" if c in cust_set
                        else f"d.{c}" for c in cust_cols)
    q = Q()
    d = dim(q, "customer")
    r = resync(q)
    out["scd1_update"] = q.sql(f"select {upd_sel} from {d} d left join {r} r on d.Src_cust_id = r.Src_cust_id")
    q = Q()
    d = dim(q, "customer")
    r = resync(q)
    out["scd1_upsert"] = q.sql(f"""select {upd_sel} from {d} d left join {r} r on d.Src_cust_id = r.Src_cust_id
union all
select (select max(row_wid) from {d}) + row_number() over (order by Src_cust_id NULLS FIRST) row_wid,
  Src_cust_id, Fname, Lname, Pmail, PhoneNo, createDt_id, UpdateDt_id
from {r} where Src_cust_id not in (select Src_cust_id from {d})""")

    for kind, xml in (("csv", False), ("xml", True)):
        q = Q()
        feed = base(q, f"{kind}_feed")
        fl = flags(q, feed, RUN, xml)
        err = q.add("errors", quarantine_sql(q, fl, RUN, xml))
        cand = q.add("cand", f"select * from {feed} where transID in (select transID from {err} where reprocessed = 'N')")
        fl2 = flags(q, feed, REPROCESS, xml, src=cand)
        out["mark_reprocessed" + "_xml" * xml] = q.sql(f"""select e.transID, e.comment,
  case when c.transID is not null and e.reprocessed = 'N' then 'Y' else e.reprocessed end reprocessed,
  e.createDt, case when c.transID is not null and e.reprocessed = 'N' then {REPROCESS} else e.updateDt end updateDt
from {err} e left join (select distinct transID from {cand}) c on e.transID = c.transID
union all
{quarantine_sql(q, fl2, REPROCESS, xml)}""")
        res = "reseller_id" if xml else "regexp_extract(source_file, 'DailySales_\\d{2}\\d{2}\\d\\d{2}_(-?\\d+)\\.csv', 1)"
        out[f"reprocess_staged_{kind}"] = q.sql(f"""select {', '.join(FEED9)}, cast({res} as bigint) Reseller_id,
  {REPROCESS} load_date, {did(REPROCESS)} BatchId from ({valid(fl2, ["reseller_id" if xml else "source_file"], xml)}) x""")

    q = Q()
    fa = fact_all(q)
    out["rollback_day"] = q.sql(
        f"select * from {fa} where not coalesce(createDt_id = {DAY_ID} or UpdateDt_id = {DAY_ID}, false)")
    q = Q()
    fa = fact_all(q)
    out["rollback_day_channel"] = q.sql(
        f"""select * from {fa} where not coalesce((createDt_id = {DAY_ID} or UpdateDt_id = {DAY_ID})
  and sold_by = 'platfrom', false)""")

    q = Q()
    out["xml_flatten"] = q.sql(f"select * from {base(q, 'xml_feed')}")

    q = Q()
    st = versions(q, "f_platform_transaction")
    out["insert_update_split"] = q.sql(f"""select TransId, load_date, CreateDate, UpdateDate,
  case when UpdateDate is null then 'insert' else 'update' end branch from {st}""")

    q = Q()
    wo = base(q, "web_order")
    out["same_day_filter"] = q.sql(
        f"select * from {wo} where created_at >= {WEB_DAY} and created_at < {WEB_DAY} + interval 1 day")

    for name in ("customer", "reseller", "venue", "location", "event"):
        q = Q()
        out[f"dim_{name}_load"] = q.sql(f"select * from {dim(q, name)}")

    q = Q()
    out["fact_platform_load"] = q.sql(f"select * from {fact_platform(q)}")
    q = Q()
    out["fact_unknown_member"] = q.sql(f"select * from {fact_platform(q)} where reseller_id = 1 and commission = 0")
    q = Q()
    out["fact_platform_inner"] = q.sql(f"select * from {fact_platform(q, unknown_member=False)}")
    q = Q()
    out["fact_same_day_update"] = q.sql(f"select * from {fact_platform(q)} where createDt_id = UpdateDt_id")
    q = Q()
    out["fact_rerun_day"] = q.sql(f"select {', '.join(FACT_COLS)} from {fact_platform(q)}")
    q = Q()
    out["dim_rerun_day"] = q.sql(" union all ".join(
        f"select '{n}' entity, row_wid, cast({k} as bigint) src_id, createDt_id, UpdateDt_id from {dim(q, n)}"
        for n, k in (("customer", "Src_cust_id"), ("venue", "src_Venue_id"), ("reseller", "src_res_id"),
                     ("location", "src_loc_id"), ("event", "src_event_id"))))
    q = Q()
    out["dim_bucketed_load"] = q.sql(f"select * from {dim(q, 'customer')}")
    q = Q()
    out["fact_csv_load"] = q.sql(f"select * from {fact_file(q, 'csv')}")
    q = Q()
    out["fact_xml_load"] = q.sql(f"select * from {fact_file(q, 'xml')}")
    q = Q()
    out["fact_all_channels"] = q.sql(f"select * from {fact_all(q)}")

    q = Q()
    tx = current(q, "f_platform_transaction")
    com = current(q, "f_commission")
    out["commission_lookup"] = q.sql(f"""select t.TransId, t.EventId, t.Reseller_id, m.Commission from {tx} t
  left join {com} m on t.EventId = m.EvntId and t.Reseller_id = m.ResId""")

    out["latest_per_key"] = latest("lineitem", ["l_orderkey", "l_linenumber"], ["l_shipdate"],
                                   ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
                                    "l_tax", "l_returnflag", "l_linestatus"])

    q = Q()
    s = base(q, "f_sale")
    out["distinct_key_count"] = q.sql(f"""select feed, count(distinct reseller_id)
  + max(case when reseller_id is null then 1 else 0 end) n_keys from {s} group by feed""")

    out["surrogate_key"] = ("select row_number() over (order by c_custkey NULLS FIRST) row_wid, c_custkey, c_name "
                            "from customer")

    q = Q()
    st = versions(q, "f_platform_transaction")
    out["count_gate"] = q.sql(f"select count(*) src_cnt, count(*) dst_cnt, true ok from {st}")

    q = Q()
    cf = base(q, "csv_feed")
    xf = base(q, "xml_feed")
    w = base(q, "weblog")
    out["non_empty_gate"] = q.sql(f"""select 'csv' source, (select count(*) > 0 from {cf}) has_rows
union all select 'xml', (select count(*) > 0 from {xf})
union all select 'weblog', (select count(*) > 0 from {w})""")

    q = Q()
    cf = base(q, "csv_feed")
    spec = [("Transaction ID", "transID", "INTEGER", False), ("Event name", "eventName", "VARCHAR", False),
            ("Number of purchased tickets", "Purchased_ticket", "INTEGER", False),
            ("Total amount", "Amount", "DOUBLE", True),
            ("Sales channel(office,web,mobile web)", "channel", "VARCHAR", False),
            ("Customer first name", "custFirstName", "VARCHAR", False),
            ("Customer last name", "custLastName", "VARCHAR", True),
            ("Office Location", "officeLoc", "VARCHAR", True), ("Created_date", "createDate", "DATE", False)]
    parts = []
    for header, col, typ, nullable in spec:
        nulls = "cast(0 as bigint)" if nullable else f"count_if({col} is null)"
        bad = f"count_if({col} is not null and try_cast(cast({col} as varchar) as {typ}) is null)"
        parts.append(f"select '{header}' column_name, {nulls} nulls, {bad} bad_casts from {cf}")
    out["schema_conformance"] = q.sql(
        "select *, nulls = 0 and bad_casts = 0 ok from (" + "\nunion all\n".join(parts) + ") x")

    q = Q()
    cf = base(q, "csv_feed")
    columns = [("Transaction ID", "transID", "bigint", False, "int bigint"), ("Event name", "eventName", "string", False, None),
               ("Number of purchased tickets", "Purchased_ticket", "int", False, "int"), ("Total amount", "Amount", "double", True, "int bigint double"),
               ("Sales channel(office,web,mobile web)", "channel", "string", False, None), ("Customer first name", "custFirstName", "string", False, None),
               ("Customer last name", "custLastName", "string", True, None), ("Office Location", "officeLoc", "string", True, None),
               ("Created_date", "createDate", "date", False, "date")]
    values = q.add("feed_values", "\nunion all\n".join(
        f"select source_file, '{h}' column_name, cast({c} as varchar) v, '{t}' declared, {null} may_be_null, '{fits or '*'}' fits from {cf}"
        for h, c, t, null, fits in columns))
    found = q.add("feed_types", f"""select source_file, column_name, declared, may_be_null, fits, count(v) n_values, count(v) < count(*) nullable,
  case when count(v) = 0 then 'void'
    when count_if(lower(v) in ('true', 'false')) = count(v) then 'boolean'
    when count_if(regexp_full_match(v, '[+-]?[0-9]{{1,18}}') and try_cast(v as integer) is not null) = count(v) then 'int'
    when count_if(regexp_full_match(v, '[+-]?[0-9]{{1,18}}')) = count(v) then 'bigint'
    when count_if(regexp_full_match(v, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?')) = count(v) then 'double'
    when count_if(regexp_full_match(v, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') and try_cast(v as date) is not null) = count(v) then 'date'
    else 'string' end type_name from {values} group by all""")
    out["schema_drift"] = q.sql(f"""select source_file, column_name, type_name, declared, nullable, n_values,
  (fits = '*' or type_name = 'void' or list_contains(string_split(fits, ' '), type_name)) and (may_be_null or not nullable) ok from {found}""")

    q = Q()
    cf = base(q, "csv_feed")
    res = current(q, "f_reseller")
    pat = "'DailySales_(\\d{2})(\\d{2})\\d(\\d{2})_(-?\\d+)\\.csv'"
    out["file_name_gate"] = q.sql(f"""select file_name, file_date, reseller_id,
  coalesce(file_date = {RUN}, false) date_ok, r.ResellerId is not null reseller_ok,
  coalesce(file_date = {RUN}, false) and r.ResellerId is not null ok
from (select file_name,
        make_date(case when cast(regexp_extract(file_name, {pat}, 3) as integer) >= 69
                       then 1900 else 2000 end + cast(regexp_extract(file_name, {pat}, 3) as integer),
                  cast(regexp_extract(file_name, {pat}, 1) as integer),
                  cast(regexp_extract(file_name, {pat}, 2) as integer)) file_date,
        cast(regexp_extract(file_name, {pat}, 4) as bigint) reseller_id
      from (select distinct source_file file_name from {cf}) n) f
  left join (select distinct ResellerId from {res}) r on f.reseller_id = r.ResellerId""")

    q = Q()
    fl = flags(q, base(q, "csv_feed"), RUN, False)
    out["rule_flags"] = q.sql(f"select * from {fl}")
    q = Q()
    fl = flags(q, base(q, "csv_feed"), RUN, False)
    out["valid_rows"] = q.sql(valid(fl, ["source_file"], False))
    q = Q()
    fl = flags(q, base(q, "csv_feed"), RUN, False)
    out["quarantine_csv"] = q.sql(quarantine_sql(q, fl, RUN, False))
    q = Q()
    fl = flags(q, base(q, "xml_feed"), RUN, True)
    out["quarantine_xml"] = q.sql(quarantine_sql(q, fl, RUN, True))

    q = Q()
    feed = base(q, "csv_feed")
    fl = flags(q, feed, RUN, False)
    err = q.add("errors", quarantine_sql(q, fl, RUN, False))
    out["reprocess_candidates"] = q.sql(
        f"select * from {feed} where transID in (select transID from {err} where reprocessed = 'N')")

    q = Q()
    entities = {"customer": "f_customer", "event": "f_event", "location": "f_location", "reseller": "f_reseller",
                "venue": "f_venue", "commission": "f_commission", "transaction": "f_platform_transaction"}
    out["reconcile_staging"] = q.sql("\nunion all\n".join([f"""select {did('load_date')} date_dim_id,
  count(distinct ({', '.join(ENTITY_KEYS[e])})) src_cnt, count(distinct ({', '.join(ENTITY_KEYS[e])})) dst_cnt, true ok, '{n}' entity
from {versions(q, e)} group by 1""" for n, e in entities.items()]))

    parts, q = [], Q()
    for kind, xml in (("csv", False), ("xml", True)):
        feed = base(q, f"{kind}_feed")
        fl = flags(q, feed, RUN, xml)
        err = q.add(f"errors_{kind}", quarantine_sql(q, fl, RUN, xml))
        ok = f"({valid(fl, [], xml)})"
        parts.append(f"""select *, src_cnt = handled_cnt and missing = 0 ok, '{kind}' feed
from (select (select count(distinct transID) from {feed}) src_cnt,
             (select count(distinct transID) from {ok} v) staged_cnt,
             (select count(distinct transID) from {err}) quarantined_cnt,
             (select count(distinct transID) from (select transID from {ok} v union all select transID from {err}) h) handled_cnt,
             (select count(distinct transID) from {feed} where transID not in (select transID from {ok} v)
                and transID not in (select transID from {err})) missing) x""")
    out["reconcile_file"] = q.sql("\nunion all\n".join(parts))

    out["column_presence"] = " union all ".join(
        f"select '{n}' column_name, 0::bigint n_missing, 0::bigint n_misplaced, true ok" for n in (
            "Transaction ID", "Event name", "Number of purchased tickets", "Total amount",
            "Sales channel(office,web,mobile web)", "Customer first name", "Customer last name", "Office Location", "Created_date"))

    q = Q()
    fa = fact_all(q)
    both = "\nunion all\n".join(
        f"select '{sold}' sold_by, BatchId, transID id, 1 side from {staged_file(q, kind)}"
        for kind, sold in (("csv", "Csv_3rdparthy_platfrom"), ("xml", "Xml_3rdparty_platfrom")))
    out["reconcile_dwh_files"] = q.sql(f"""select sold_by, BatchId, count(*) filter (s) src_cnt, count(*) filter (d) dst_cnt,
  count(*) filter (not d) missing, count(*) filter (s) = count(*) filter (d) and count(*) filter (not d) = 0 ok
from (select sold_by, BatchId, id, bool_or(side = 1) s, bool_or(side = 2) d
      from ({both} union all select sold_by, BatchId, src_trans_id, 2 from {fa}) t group by 1, 2, 3) u
group by 1, 2 having count(*) filter (s) > 0""")

    def per_day(src_sql: str, dst_sql: str, group: str = "") -> str:
        g = f"{group}, " if group else ""
        on = f" and s.{group} = d.{group}" if group else ""
        gsel = f"coalesce(s.{group}, d.{group}) {group}, " if group else ""
        return f"""select {gsel}coalesce(s.date_dim_id, d.date_dim_id) date_dim_id,
  coalesce(s.n, 0) src_cnt, coalesce(d.n, 0) dst_cnt, coalesce(s.n, 0) = coalesce(d.n, 0) ok
from ({src_sql}) s full outer join ({dst_sql}) d on s.date_dim_id = d.date_dim_id{on}"""

    q = Q()
    parts = []
    for n, (ent, key, *_) in DIMS.items():
        st, dc = versions(q, ent), dim(q, n)
        parts.append("select *, '" + n + "' entity from (" + per_day(
            f"select {did('load_date')} date_dim_id, count(distinct {key}) n from {st} group by 1",
            f"""select date_dim_id, count(*) n from (
  select createDt_id date_dim_id from {dc} where createDt_id is not null
  union all select UpdateDt_id from {dc} where UpdateDt_id is not null
    and (createDt_id is null or UpdateDt_id <> createDt_id)) x group by 1""") + ") y")
    out["reconcile_dwh"] = q.sql("\nunion all\n".join(parts))

    q = Q()
    st = versions(q, "f_platform_transaction")
    fa = fact_all(q)
    out["reconcile_dwh_channel"] = q.sql(per_day(
        f"select 'platfrom' sold_by, {did('load_date')} date_dim_id, count(distinct TransId) n from {st} group by 2",
        f"""select sold_by, date_dim_id, count(*) n from (
  select sold_by, createDt_id date_dim_id from {fa} where createDt_id is not null and sold_by = 'platfrom'
  union all select sold_by, UpdateDt_id from {fa} where UpdateDt_id is not null and sold_by = 'platfrom'
    and (createDt_id is null or UpdateDt_id <> createDt_id)) x group by 1, 2""", group="sold_by"))

    q = Q()
    st = versions(q, "f_platform_transaction")
    m = q.add("months", f"select distinct {did('load_date')} // 100 month_id, TransId from {st}")
    lossy = q.add("lossy", f"""select * from {m} where TransId % 997 <> 5 and month_id <> 199803
  union all select month_id, TransId + 1000000000000 from {m} where TransId % 1499 = 7""")
    out["differing_keys"] = q.sql(f"""select month_id, TransId, 'missing' side from {m} anti join {lossy} using (month_id, TransId)
union all select month_id, TransId, 'extra' from {lossy} anti join {m} using (month_id, TransId)""")
    out["distinct_keys_by_month"] = q.sql(f"""select month_id, coalesce(s.n, 0) src_cnt, coalesce(d.n, 0) dst_cnt,
  not exists (select 1 from {m} a anti join {lossy} b using (month_id, TransId) where a.month_id = month_id_)
  and not exists (select 1 from {lossy} a anti join {m} b using (month_id, TransId) where a.month_id = month_id_) ok
from (select month_id, month_id month_id_, count(*) n from {m} group by all) s full join (select month_id, count(distinct TransId) n from {lossy} group by all) d using (month_id)""")
    out["repeated_keys"] = "select l_orderkey, l_linenumber, count(*) n from lineitem group by all having count(*) > 1"
    q = Q()
    ev = current(q, "f_event")
    out["hot_name_lookup"] = q.sql(f"""select f.transID, f.eventName, e.EventId, e.TicketCost from (
  select transID, case when transID % 2 = 0 then 'Event#1' else eventName end eventName from {base(q, 'csv_feed')}) f
left join {ev} e on e.EventName = f.eventName""")
    out["duplicate_lookup_keys"] = ("select p_name EventName, count(*) n from part group by p_name "
                                    "having count(*) > 1")
    out["weblog_load_check"] = "select cast(ts as date) log_date, count(*) n_rows from events group by 1"

    q = Q()
    out["mart_customer_load"] = q.sql(f"select * from {mart_customers(q)}")
    q = Q()
    out["mart_company_load"] = q.sql(f"select * from {mart_companies(q)}")
    q = Q()
    out["product_dim_load"] = q.sql(f"select * from {products(q)}")
    q = Q()
    out["geoip_range_join"] = q.sql(f"select request, client_ip, country_name from {request_country(q)}")
    q = Q()
    w = base(q, "weblog")
    nested = q.add("nested", """select cast(10 + n_nationkey * 8 + j as bigint) * 16777216 s, case when j = 7 then 8388608 else 16777216 end size, n_nationkey c
  from nation, range(8) r(j)
union all select cast(10 + n_nationkey * 8 + j as bigint) * 16777216 + 64 * 65536, 4194304, (n_nationkey + 1) % 25 from nation, range(7) r(j)
union all select cast(10 + n_nationkey * 8 + j as bigint) * 16777216 + 80 * 65536, 1048576, (n_nationkey + 2) % 25 from nation, range(7) r(j)
union all select 0, 2147483648, 24""")
    out["geoip_nested"] = q.sql(f"""select request, client_ip, n_name country_name from (
  select request, client_ip, c from {w} left join {nested} on {ip_long('client_ip')} >= s and {ip_long('client_ip')} < s + size
  qualify row_number() over (partition by request order by size) = 1) x left join nation on n_nationkey = c""")
    out["geoip_ipv6"] = """select event_id, client_ip, ip_ok, n_name country_name from (
  select event_id, case when event_id % 50 = 0 then '2001:db8::1::2'
      else '2001:db8:' || lower(printf('%x', user_id % 256)) || '::' || lower(printf('%x', event_id % 65536)) end client_ip,
    event_id % 50 <> 0 ip_ok, (user_id % 256) g from events) e
  left join nation on ip_ok and n_nationkey = case when g % 8 = 3 and g // 8 + 1 < 25 then g // 8 + 1 else g // 8 end"""
    q = Q()
    days = f"cast(created_at as date) between cast({WEB_DAY} as date) and cast({WEB_DAY} as date) + 1"
    out["mart_two_days"] = q.sql(f"""select 'customer' entity, cast(created_at as date) load_date,
  row_number() over (order by cast(created_at as date), cust_document_no) as key, cust_document_no src_id
from {base(q, 'web_customer')} where {days}
union all
select 'product', cast(created_at as date), row_number() over (order by cast(created_at as date), r, prod_id), prod_id from (
  select created_at, 0 r, prod_id from {base(q, 'supplier_products')} union all select created_at, 1, prod_id from {base(q, 'seller_products')}) p
where {days}""")
    q = Q()
    out["order_request_load"] = q.sql(f"select * from {order_requests(q)}")
    q = Q()
    out["conditional_left_join"] = q.sql(f"""select order_id, order_item_id, order_src_type, c_name, cp_name,
  sp_prod_id, slp_prod_id from {order_lines(q)}""")
    q = Q()
    out["order_fact_load"] = q.sql(order_fact(q))
    return out


ORACLE_SQL = _sql()
