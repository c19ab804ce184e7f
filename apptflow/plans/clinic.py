"""Clinic-shaped tables derived from the star-schema test tables.

Each property is a lazy DataFrame; a query reads only the columns it uses.
All keys and times come from integer arithmetic, so that another SQL engine
derives the same rows.
"""

from __future__ import annotations

from datetime import datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from apptflow.operators import payments
from apptflow.plans import runs

AS_OF = datetime(2024, 1, 15, 12, 0, 0)
SURVEY_MORNING = datetime(2024, 1, 15, 11, 30, 0)
SURVEY_AFTERNOON = datetime(2024, 1, 15, 16, 30, 0)
USERS_PER_PAGE = 40


def page_number(k: Column) -> Column:
    """A number for page k; no two of the first million pages share one."""
    return k * 7919 % 1000003 + 10


#: the number of page 0
FIRST_SHUFFLED_PAGE = 10


class Clinic:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir.rstrip("/")
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:  # opening a file reads its schema: do it once
            self._raw[name] = self.spark.read.parquet(f"{self.dir}/{name}.parquet")
        return self._raw[name]

    @cached_property
    def doctors(self) -> int:
        """Number of doctors: appointments are dealt to them in turn."""
        return self.raw("supplier").count()

    # --- people ---------------------------------------------------------------

    @property
    def clients(self) -> DataFrame:
        return self.raw("customer").selectExpr(
            "c_custkey AS pcode",
            "c_name AS fullname",
            "'H' || c_custkey AS histnum",
            "CASE WHEN c_custkey % 4 <> 0 THEN '+7 (9' || lpad(c_custkey % 100, 2, '0') || ') 555-'"
            " || lpad(c_custkey % 10000, 4, '0') END AS phone3",
            "CASE WHEN c_custkey % 3 = 0 THEN '8495' || lpad(c_custkey % 10000000, 7, '0') ELSE '' END AS phone2",
            "CASE WHEN c_custkey % 8 = 0 THEN '89' || lpad(c_custkey % 1000000000, 9, '0') ELSE 'n/a' END AS phone1",
            "make_date(cast(1950 + c_custkey % 60 AS int), cast(1 + c_custkey % 12 AS int),"
            " cast(1 + c_custkey % 28 AS int)) AS bdate",
            "cast(c_custkey % 3 AS int) AS webpaytype",
            "cast(c_custkey % 4 AS int) AS webaccesstype",
            "CASE WHEN c_custkey % 11 = 0 THEN 1 WHEN c_custkey % 2 = 0 THEN 0 END AS refusesms",
        )

    @property
    def warehouse_clients(self) -> DataFrame:
        c = self.clients
        return c.select(
            "pcode", "fullname", "bdate", F.col("phone3").alias("phone"), "phone2", "phone3", "refusesms"
        )

    @property
    def doctor(self) -> DataFrame:
        return self.raw("supplier").selectExpr(
            "s_suppkey AS dcode",
            "s_name AS dname",
            "'8 (9' || lpad(s_suppkey % 100, 2, '0') || ') 555-0000' AS phoneint",
            "CASE WHEN s_suppkey % 5 = 0 THEN 'ab' ELSE 'Doc' || s_suppkey END AS onlineuserid",
        )

    @property
    def doctor_dim(self) -> DataFrame:
        return self.raw("supplier").selectExpr(
            "s_suppkey AS uid",
            "s_name AS fullname",
            "'PROF' || (s_suppkey % 9) AS profname",
            "CASE WHEN s_suppkey % 7 = 0 THEN 'Nurse' WHEN s_suppkey % 13 = 0 THEN NULL"
            " ELSE 'Doctor' END AS doctpost",
        )

    @property
    def doctor_links(self) -> DataFrame:
        return self.raw("supplier").selectExpr(
            "s_suppkey AS dcode",
            "CASE WHEN s_suppkey % 4 <> 0 THEN 'https://example.org/d/' || s_suppkey END AS link",
        )

    @property
    def users(self) -> DataFrame:
        return self.raw("customer").selectExpr(
            "c_custkey AS list_pos",
            f"CASE WHEN c_custkey < {self.doctors} THEN 'doc' ELSE 'guest' END || c_custkey AS userid",
            "element_at(array(-2, 1, 2, 5, 0, -1), cast(c_custkey % 6 AS int) + 1) AS status",
        )

    # --- schedule ---------------------------------------------------------------

    @property
    def schedule(self) -> DataFrame:
        return self.raw("orders").selectExpr(
            "o_orderkey AS schedid",
            "o_orderkey AS schedident",
            "o_custkey AS pcode",
            f"o_orderkey % {self.doctors} AS dcode",
            "o_orderkey % 7 AS chid",
            "date_add(DATE'2024-01-13', cast((o_orderkey DIV 100) % 5 AS int)) AS workdate",
            "cast(8 + (o_orderkey DIV 5) % 13 AS int) AS bhour",
            "cast(5 * ((o_orderkey DIV 65) % 12) AS int) AS bmin",
            "TIMESTAMP_NTZ'2024-01-15 00:00:00'"
            " + make_dt_interval(0, 0, 0, o_orderkey * 7919 % 86400) AS createdate",
            "CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'F' THEN o_custkey END AS emid",
            "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS onlinetype",
            "CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey END AS planid",
            "o_custkey % 17 + 1 AS filial",
        )

    @property
    def roster(self) -> DataFrame:
        return (
            self.schedule.select("dcode", F.col("workdate").alias("wdate"), F.col("chid").alias("chair"))
            .distinct()
            .selectExpr(
                "dcode",
                "wdate",
                "chair",
                "dcode % 6 AS depnum",
                "1 AS daytype",
                "8 AS beghour",
                "0 AS begmin",
                "21 AS endhour",
                "0 AS endmin",
            )
        )

    @property
    def roster_by_ident(self) -> DataFrame:
        return self.schedule.selectExpr("schedident", "dcode % 6 AS depnum")

    @property
    def chairs(self) -> DataFrame:
        return self.spark.range(7).selectExpr("id AS chid", "id % 3 AS rid")

    @property
    def rooms(self) -> DataFrame:
        return self.chairs.select("rid").distinct()

    @property
    def departments(self) -> DataFrame:
        return self.raw("supplier").selectExpr("s_suppkey % 6 AS depnum").distinct().selectExpr(
            "depnum", "'DEP' || depnum AS depname"
        )

    @property
    def filials(self) -> DataFrame:
        return self.raw("orders").selectExpr("o_custkey % 17 + 1 AS filid").distinct().selectExpr(
            "filid", "'BR' || filid AS shortname"
        )

    # --- services and plans -------------------------------------------------------

    @property
    def wschema(self) -> DataFrame:
        return self.raw("part").selectExpr(
            "p_partkey AS schid",
            "p_name AS schname",
            "CASE WHEN p_partkey % 40 = 0 THEN 'workload' WHEN p_partkey % 10 = 0 THEN 'online'"
            " ELSE 'clinic' END AS listing",
        )

    @property
    def online_services(self) -> DataFrame:
        return self.wschema.where(F.col("listing").isin("online", "workload")).select("schid")

    @property
    def workload_services(self) -> DataFrame:
        return self.wschema.where(F.col("listing") == "workload").select("schid")

    @property
    def dailyplan(self) -> DataFrame:
        return self.raw("orders").selectExpr(
            "o_orderkey AS did",
            "CASE WHEN o_orderkey % 2 = 0 THEN 204 ELSE 100 END AS plantype",
            "cast(o_totalprice AS decimal(18,2)) AS summarub_disc",
        )

    @property
    def sched_detail(self) -> DataFrame:
        lines = self.raw("lineitem").where("l_linestatus = 'O'")
        return lines.selectExpr("l_orderkey AS schedid", "l_partkey AS schid")

    @property
    def plan_detail(self) -> DataFrame:
        lines = self.raw("lineitem").where("l_linestatus = 'F'")
        return lines.selectExpr("l_orderkey AS did", "l_partkey AS schid")

    # --- money ----------------------------------------------------------------------

    def _payments(self, where: str, *extra: str) -> DataFrame:
        owners = self.raw("orders").selectExpr("o_orderkey", "o_custkey AS pcode", "o_orderstatus")
        lines = self.raw("lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
        return (
            lines.join(owners, "o_orderkey")
            .where(where)
            .selectExpr(
                "pcode", "o_orderkey AS planid", "cast(l_extendedprice AS decimal(18,2)) AS amountrub", *extra
            )
        )

    @property
    def incom(self) -> DataFrame:
        return self._payments(
            "l_returnflag = 'N'",
            "l_linenumber AS paycode",
            "CASE WHEN l_suppkey % 6 <> 0 THEN l_suppkey % 15 END AS incref",
        )

    @property
    def losecredit(self) -> DataFrame:
        return self._payments("l_returnflag = 'R' AND o_orderstatus = 'F'")

    @property
    def jppayments(self) -> DataFrame:
        return self._payments(
            "l_returnflag = 'R' AND o_orderstatus = 'O'", "l_linenumber AS opertype", "l_suppkey % 15 AS incref"
        )

    @property
    def clavans(self) -> DataFrame:
        return self._payments(
            "l_returnflag = 'A'", "CASE WHEN l_linenumber = 7 THEN 102 ELSE l_linenumber END AS typeoper"
        )

    @property
    def movements(self) -> DataFrame:
        return payments.payment_movements(self.incom, self.losecredit, self.jppayments, self.clavans)

    @property
    def agreements(self) -> DataFrame:
        parts = self.agreement_tables
        return payments.agreement_lines(*parts)

    @property
    def agreement_tables(self) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
        clhistnum = self.raw("orders").selectExpr(
            "o_custkey AS pcode",
            "o_custkey % 25 AS jid",
            "o_custkey % 5 AS lstid",
            "o_orderkey AS agrid",
            "cast(o_orderdate AS date) AS bdate",
            "date_add(cast(o_orderdate AS date), 9000) AS fdate",
            "CASE WHEN o_orderkey % 4 = 0 THEN date_add(cast(o_orderdate AS date), 3000) END AS datecancel",
            "CASE WHEN o_orderkey % 9 = 0 THEN 1 END AS isdeleted",
        )
        jpersons = self.raw("nation").selectExpr("cast(n_nationkey AS bigint) AS jid", "n_name AS jname")
        jplists = self.raw("region").selectExpr("cast(r_regionkey AS bigint) AS lid", "r_name AS shortname")
        jpagreement = self.raw("orders").selectExpr("o_orderkey AS agrid", "'AG' || o_orderkey AS agnum")
        return clhistnum, jpersons, jplists, jpagreement

    @property
    def payment_tables(self) -> payments.PaymentTables:
        return payments.PaymentTables(
            schedule=self.schedule,
            filials=self.filials,
            doctor=self.doctor,
            clients=self.clients,
            roster=self.roster_by_ident,
            departments=self.departments,
            dailyplan=self.dailyplan,
            plan_detail=self.plan_detail,
            sched_detail=self.sched_detail,
            agreements=self.agreements,
            movements=self.movements,
        )

    @property
    def appointment_tables(self) -> runs.AppointmentTables:
        return runs.AppointmentTables(
            schedule=self.schedule,
            clients=self.clients,
            chairs=self.chairs,
            rooms=self.rooms,
            roster=self.roster,
            doctor=self.doctor,
            plan_detail=self.plan_detail,
            sched_detail=self.sched_detail,
        )

    @property
    def workload_tables(self) -> runs.WorkloadTables:
        return runs.WorkloadTables(
            schedule=self.schedule,
            roster=self.roster,
            departments=self.departments,
            dailyplan=self.dailyplan,
            plan_detail=self.plan_detail,
            sched_detail=self.sched_detail,
            doctor=self.doctor,
        )

    @property
    def survey_tables(self) -> runs.SurveyTables:
        return runs.SurveyTables(
            visits=self.visits,
            clients=self.warehouse_clients,
            doctors=self.doctor_dim,
            links=self.doctor_links,
            orderdet=self.orderdet,
            wschema=self.wschema,
            treats=self.treats,
        )

    # --- visits -----------------------------------------------------------------------

    @property
    def visits(self) -> DataFrame:
        return (
            self.raw("orders")
            .where("o_orderkey % 5 = 0")
            .selectExpr(
                "o_orderkey AS schedid",
                "o_custkey AS pcode",
                f"o_orderkey % {self.doctors} AS dcode",
                "TIMESTAMP_NTZ'2024-01-14 08:00:00'"
                " + make_dt_interval(0, 0, 0, o_orderkey * 61 % 129600) AS schedule_date",
                "CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS treatcode",
                "o_custkey % 17 + 1 AS target_filid",
                "'BR' || (o_custkey % 17 + 1) AS target_fil_shortname",
                f"'DEP' || (o_orderkey % {self.doctors} % 6) AS department",
            )
        )

    @property
    def treats(self) -> DataFrame:
        return (
            self.raw("orders")
            .where("o_orderkey % 5 <> 0")
            .selectExpr(
                "o_orderkey + 1000000000 AS treatcode",
                "o_custkey AS pcode",
                f"(o_orderkey DIV 5) % {self.doctors} AS dcode",
                "o_orderdate + INTERVAL '9000' DAY AS treatdate",
            )
        )

    @property
    def orderdet(self) -> DataFrame:
        return self.raw("lineitem").selectExpr(
            "l_orderkey AS treatcode",
            "l_partkey AS schid",
            "l_returnflag = 'N' AS is_nal",
            "CASE WHEN l_returnflag = 'N' THEN 'cash' ELSE 'insured' END AS docname",
            "cast(l_extendedprice AS decimal(18,2)) AS schamount",
        )

    # --- ledger, results, reports, pages -------------------------------------------------

    @property
    def ledger(self) -> DataFrame:
        return self.schedule.where("schedid % 6 = 0").selectExpr(
            "'k' || (schedid % 5) AS kind", "cast(schedid AS string) AS key", "createdate AS sent_at"
        )

    def sent(self, kind: str) -> DataFrame:
        """The same ledger, all under one kind."""
        return self.ledger.withColumn("kind", F.lit(kind))

    @property
    def delivery(self) -> DataFrame:
        return self.raw("events").selectExpr(
            "event_id AS smsid",
            "ts AS reported_at",
            "CASE WHEN event_id % 17 = 0 THEN 'junk' WHEN event_id % 3 = 0 THEN '-1'"
            " ELSE (event_id % 4) || ' ' || date_format(ts, 'yyyyMMddHHmm') END AS content",
        )

    @property
    def arrivals(self) -> DataFrame:
        return self.schedule.selectExpr("'f' || schedid AS file", "createdate AS created")

    @property
    def arrivals_known(self) -> DataFrame:
        return self.ledger.selectExpr("'file' AS kind", "'f' || key AS key", "sent_at")

    @property
    def conference_pages(self) -> DataFrame:
        conf = self.raw("orders").selectExpr(
            "o_orderkey",
            "named_struct('id', cast(o_orderkey AS string),"
            " 'topic', CASE WHEN o_orderkey % 2 = 0 THEN 'visit ' || lpad(o_orderkey, 10, '9') ELSE 'visit' END,"
            " 'owner', 'u' || o_custkey || '@example.org', 'type', cast(o_orderkey % 4 AS int),"
            " 'schedule', named_struct('type', 1, 'start_time', 1705276800 + o_orderkey * 60),"
            " 'state', CASE o_orderstatus WHEN 'O' THEN 'running' ELSE 'stopped' END) AS c",
        )
        total = conf.agg(F.count("*").alias("n")).scalar()
        pages = conf.groupBy(F.expr("o_orderkey DIV 200 + 1").alias("page_id")).agg(
            F.sort_array(F.collect_list("c")).alias("conferences")
        )
        return pages.select(
            "page_id", F.to_json(F.struct(total.alias("cnt"), "conferences")).alias("body")
        )

    @property
    def user_pages(self) -> DataFrame:
        """Pages of 40 users, each naming the next one; -1 ends the chain."""
        users = self.users.selectExpr(
            f"list_pos DIV {USERS_PER_PAGE} AS page_id",
            "named_struct('n', list_pos, 'id', userid, 'uid', userid || '@example.org', 'status', status) AS u",
        )
        last = users.agg(F.max("page_id").alias("p")).scalar()
        pages = users.groupBy("page_id").agg(F.sort_array(F.collect_list("u")).alias("users"))
        next_page = F.when(F.col("page_id") == last, -1).otherwise(F.col("page_id") + 1)
        return pages.select(
            "page_id", F.to_json(F.struct(next_page.alias("next_page_id"), "users")).alias("body")
        )

    @property
    def shuffled_user_pages(self) -> DataFrame:
        """The same pages under numbers that are in no order: page k is ``page_number(k)``."""
        renamed = self.user_pages.select(
            page_number(F.col("page_id")).alias("page_id"),
            F.get_json_object("body", "$.next_page_id").cast("bigint").alias("next"),
            F.from_json("body", "struct<users: array<struct<id: string, uid: string, status: int>>>").alias("p"),
        )
        next_page = F.when(F.col("next") == -1, -1).otherwise(page_number(F.col("next")))
        return renamed.select(
            "page_id", F.to_json(F.struct(next_page.alias("next_page_id"), "p.users")).alias("body")
        )
