"""Joins that several reports share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from wardbook.functions.scalars import site_short_name
from wardbook.sources.tables import pick


def sites(t) -> DataFrame:
    return pick(t["adncenate"], site="oid", site_code="acacodigo", site_name="acanombre").withColumn(
        "SEDE", site_short_name("site_name")
    )


def floors(t) -> DataFrame:
    return pick(t["hpnsubgru"], floor="oid", PISO="hsunombre")


def beds(t) -> DataFrame:
    return pick(
        t["hpndefcam"],
        bed="oid",
        site="adncenate",
        floor="hpnsubgru",
        bed_group="hpngrupos",
        bed_state="hcaestado",
        bed_class="hcaobshos",
        current_admission="adningreso",
    )


def stays(t) -> DataFrame:
    return pick(t["hpnestanc"], bed="hpndefcam", admission="adningres", start="hesfecing", end="hesfecsal")


def procedures(t) -> DataFrame:
    """Procedure part of a service with its code and billing group, where known."""
    part = pick(t["slnserhoj"], service="oid", procedure="genserips1")
    return (
        part.join(pick(t["genserips"], procedure="oid", CUP="sipcodcup", billing_group="genconfac1"), "procedure", "left")
        .join(pick(t["genconfac"], billing_group="oid", group_name="gcfnombre"), "billing_group", "left")
        .select("service", "CUP", "group_name")
    )


def drug_lines(t) -> DataFrame:
    """Supply lines of the drug part of a service.

    A drug part without lines says nothing to a left join, so inner is
    enough here; the supply header has one row per key and no column in use.
    """
    lines = pick(t["innmsumpa"], service="slnprohoj", line_value="ismvalpro")
    part = pick(t["slnprohoj"], service="oid")
    return lines.join(part, "service")


def with_plan(df: DataFrame, t) -> DataFrame:
    """Add benefit plan, contract and payer by the column ``plan``.

    One join per table: Spark knows the size of each, and so which to
    broadcast, but not that of a join of them.
    """
    plan = pick(
        t["gendetcon"], plan="oid", plan_code="gdecodigo", plan_name="gdenombre", plan_type="gdetippla",
        contract="gencontra1",
    )
    contract = pick(t["gencontra"], contract="oid", payer="dgnentadm1")
    payer = pick(t["geenentadm"], payer="oid", payer_code="entcodigo", payer_name="entnombre")
    return df.join(plan, "plan").join(contract, "contract").join(payer, "payer").drop("contract", "payer")
