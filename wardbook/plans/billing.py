"""Invoices, filings, sales and collections."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardbook.functions.codes import EXCLUDED_INVOICE_TYPES, FILING_STATE, INVOICE_TYPE, REPORT_START
from wardbook.functions.predicates import between_instants, number_not_in
from wardbook.functions.scalars import decode, null_text, truncate
from wardbook.operators.joins import having
from wardbook.sources.tables import pick

_CANCELLED_ORDER = 2


def filed_invoices(t) -> DataFrame:
    """Invoices that were filed, with the state and date of the filing."""
    invoice = pick(t["slnfactur"], invoice="oid", SFANUMFAC="sfanumfac")
    line = pick(t["crnradfacd"], invoice="slnfactur", filing="crnradfacc", CRFFECRAD="crffecrad")
    filing = pick(t["crnradfacc"], filing="oid", state="crfestado")
    rows = line.join(filing, "filing").join(invoice, "invoice")
    return rows.select("SFANUMFAC", decode("state", FILING_STATE).alias("ESTADO"), "CRFFECRAD")


def countable_invoices(t, as_of, start=REPORT_START) -> DataFrame:
    """Invoices of a period that are neither cancelled nor drafts, carry a voucher and are of a counted type."""
    invoice = pick(
        t["slnfactur"],
        admission="adningreso",
        FACTURADOR="genusuario1",
        FACTURA="sfanumfac",
        SFAFECFAC="sfafecfac",
        total="sfatotfac",
        RECIBO_DE_CAJA="sfavalrec",
        FRANQUICIA="sfavalfra",
        cancelled="sfadocanu",
        state="sfaestdoc",
        kind="sfatipdoc",
        voucher1="ctntipcom1",
        voucher3="ctntipcom3",
    )
    return invoice.filter(
        between_instants("SFAFECFAC", start, as_of)
        & (F.col("cancelled") == 0)
        & (F.col("state") != 0)
        & number_not_in("kind", EXCLUDED_INVOICE_TYPES)
        & (F.col("voucher1").isNotNull() | F.col("voucher3").isNotNull())
    )


def invoices(t, as_of, start=REPORT_START) -> DataFrame:
    """Invoices with total and collector; equal rows fall together and add up."""
    admission = pick(t["adningreso"], admission="oid", INGCONSECUTIVO="ainconsec")
    user = pick(t["genusuario"], FACTURADOR="oid", NOMFACT="usudescri")
    rows = countable_invoices(t, as_of, start).join(admission, "admission").join(user, "FACTURADOR")
    detail = [
        "INGCONSECUTIVO", "SFAFECFAC", "FACTURA", "total", "RECIBO_DE_CAJA", "FRANQUICIA", "kind",
        "FACTURADOR", "NOMFACT",
    ]
    due = F.col("total") + F.col("RECIBO_DE_CAJA") - F.col("FRANQUICIA")
    return (
        rows.groupBy(*detail)
        .agg(F.sum(due).alias("VALORTOTAL"))
        .select(
            "INGCONSECUTIVO",
            "FACTURA",
            "SFAFECFAC",
            truncate("total", 0).alias("VALOR"),
            "RECIBO_DE_CAJA",
            "FRANQUICIA",
            "VALORTOTAL",
            decode("kind", INVOICE_TYPE, default=null_text()).alias("TIPO_FACTURA"),
            "FACTURADOR",
            "NOMFACT",
        )
        .orderBy(F.col("FACTURA").asc_nulls_last())
    )


def sales(t, as_of, start=REPORT_START) -> DataFrame:
    """Number and value of the services sold per admission and service instant."""
    service = pick(
        t["slnserpro"],
        admission="adningres1",
        order="slnordser1",
        FECHASER="serfecser",
        quantity="sercantid",
        value="servalpro",
        applied="seraplpro",
    ).filter(between_instants("FECHASER", start, as_of) & (F.col("applied") != 1))
    valid_order = t["slnordser"].filter(F.col("sosestado") != _CANCELLED_ORDER)
    admission = pick(t["adningreso"], admission="oid", INGRESO="ainconsec", state="ainestado").filter(
        F.col("state").isin(0, 1, 3)
    )
    return (
        having(service, valid_order, "order")
        .join(admission, "admission")
        .groupBy("INGRESO", "FECHASER")
        .agg(
            F.count("quantity").alias("CANTIDAD"),
            F.sum(F.col("quantity") * F.col("value")).alias("VALOR"),
        )
        .select("INGRESO", "CANTIDAD", "VALOR", "FECHASER")
    )


def collections(t) -> DataFrame:
    """Receivables transfers to third parties of the counted kinds, newest document text first."""
    line = pick(
        t["crnmtrasl"], transfer="crnctrasl", third="gentercer", receivable="crncxc", VALOR_TRASLADO="cmtnvalor"
    )
    third = t["gentercer"].filter(F.col("tertipcon").isin(1, 2, 3))
    transfer = pick(t["crnctrasl"], transfer="oid", TRASLADO="cctnumtra", FECHA_TRASLADO="cctfectra")
    receivable = pick(
        t["crncxc"], receivable="oid", FACTURA="cxcdocume", FECHA_VENCIMIENTO="cxcdocfecven", SALDO_CARTERA="crnsaldo"
    )
    return (
        having(line, third, "third")
        .join(transfer, "transfer")
        .join(receivable, "receivable")
        .select("TRASLADO", "FACTURA", "FECHA_VENCIMIENTO", "FECHA_TRASLADO", "VALOR_TRASLADO", "SALDO_CARTERA")
        # The further keys let rows without a document, or of one large one, fall into several ranges.
        .orderBy(F.col("FACTURA").desc_nulls_first(), "FECHA_TRASLADO", "TRASLADO", "VALOR_TRASLADO")
    )
