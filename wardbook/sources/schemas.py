"""Column types of the source tables, by table name.

L long key, I whole-number code, S text, D decimal(18,2), T zone-less instant.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

_TYPES = {
    "L": LongType(),
    "I": IntegerType(),
    "S": StringType(),
    "D": DecimalType(18, 2),
    "T": TimestampNTZType(),
}

TABLES = {
    # places
    "adncenate": "oid L, acacodigo S, acanombre S",  # site
    "hpnsubgru": "oid L, hsunombre S",  # floor
    "hpngrupos": "oid L, hgrnombre S",  # bed group
    "hpndefcam": "oid L, adncenate L, hpnsubgru L, hpngrupos L, hcaestado I, hcacodigo S, hcaobshos I, adningreso L",  # bed
    "hpnestanc": "hpndefcam L, adningres L, hesfecing T, hesfecsal T",  # stay
    # people and admissions
    "genpacien": "oid L, gpanomcom S, pactipdoc I, pacnumdoc S, gpafecnac T, gpasexpac I",  # patient
    "adningreso": "oid L, ainconsec L, ainfecing T, genpacien L, gendetcon L, adncenate L, hpndefcam L, adnegreso L, "
    "hcentriage L, ainestado I, aintiping I, ainurgcon I, aincauing I, aintiprie I, ainfechos T, ainfecegre T, ainfecfac T",  # admission
    "adnegreso": "oid L, adningreso L, adefecsal T, adeestpac I, adealturg I",  # discharge
    "adndiaegr": "adnegreso L, diacodigo L, tipo I",  # discharge diagnosis
    "gendiagno": "oid L, diacodigo S",  # diagnosis catalogue
    # services
    "slnserpro": "oid L, adningres1 L, slnordser1 L, genmedico1 L, serdesser S, serfecser T, sercantid D, servalpro D, "
    "servalpac D, servalent D, seraplpro I",  # service
    "slnprohoj": "oid L, inncsumpa1 L, innproduc1 L",  # drug part of a service
    "inncsumpa": "oid L",  # supply header
    "innmsumpa": "slnprohoj L, ismvalpro D",  # supply line
    "innproduc": "oid L, iprcodigo S, igrcodigo L, isgcodigo L",  # product
    "inngrupo": "oid L, igrcodigo S, igrnombre S",
    "innsubgru": "oid L, isgcodigo S, isgnombre S",
    "slnserhoj": "oid L, genserips1 L, genmanser1 L",  # procedure part of a service
    "genserips": "oid L, sipcodigo S, sipcodcup S, genconfac1 L, gengrupos1 L, gensubgru1 L",  # procedure
    "genconfac": "oid L, gcfnombre S",  # billing group
    "gengrupos": "oid L, ggrcodigo S, ggrnombre S",
    "gensubgru": "oid L, gsucodigo S, gsunombre S",
    "genmanser": "oid L, gengruqui1 L",  # manual entry
    "genmantar": "oid L, genmanser1 L, smtvalser D",  # tariff version
    "gengruqui": "oid L, sgqcodigo S, sgqnombre S",  # surgical group
    "slnordser": "oid L, sosordser L, sosfecord T, sosestado I, genareser1 L",  # service order
    "genareser": "oid L, gascodigo S, gasnombre S, ctncencos1 L",  # service area
    "ctncencos": "oid L, cccodigo S, ccnombre S",  # cost centre
    "genmedico": "oid L, gmecodigo S, gmenomcom S",  # physician
    # plans and payers
    "gendetcon": "oid L, gdecodigo S, gdenombre S, gdetippla I, gencontra1 L",  # plan
    "gencontra": "oid L, dgnentadm1 L",  # contract
    "geenentadm": "oid L, entcodigo S, entnombre S",  # payer
    # billing
    "slnfactur": "oid L, adningreso L, genusuario1 L, sfanumfac S, sfafecfac T, sfatotfac D, sfavalrec D, sfavalfra D, "
    "sfavalcar D, sfadocanu I, sfaestdoc I, sfatipdoc S, ctntipcom1 L, ctntipcom3 L",  # invoice
    "genusuario": "oid L, usudescri S",  # user
    "crnradfacd": "slnfactur L, crnradfacc L, crffecrad T",  # filing line
    "crnradfacc": "oid L, crfestado I",  # filing
    "crnmtrasl": "crnctrasl L, gentercer L, crncxc L, cmtnvalor D",  # transfer line
    "crnctrasl": "oid L, cctnumtra S, cctfectra T",  # transfer
    "crncxc": "oid L, cxcdocume S, cxcdocfecven T, crnsaldo D",  # receivable
    "gentercer": "oid L, tertipcon I",  # third party
    # appointments
    "cmncitmed": "oid L, cmntipact L, cmnhormed L, genpacien L, genespeci L, gendetcon L, genmedico1 L, ccmfecasi T, "
    "ccmfeccit T, ccmestado I, ccmpacdoc S",  # appointment
    "cmnhormed": "oid L, adncenate L",  # timetable
    "cmntipact": "oid L, cmanombre S, cmatipcon I, cmaconsul I",  # activity
    "genespeci": "oid L",  # specialty
    "cmnconsul": "adncenate L, ccnurgen I",  # consulting room
    # clinical records
    "hcnfolio": "oid L, hcntiphis L, adningreso L, hcfecfol T",  # folio
    "hcntiphis": "oid L",  # folio type
    "hcnrefer": "hcnfolio L",  # referral
    "hcntriage": "oid L, adncenate L, hcnclaurgtr L, genpacien L, hctfectri T",  # triage
    "hcnclaurgtr": "oid L, hccodigo S",  # triage class
    "hcninyacc": "oid L, adningreso L, iyafecdoc T",  # adverse event record
    "hcniyaevts": "InsidentesAccidentes L, EventosAdversos I",  # adverse event
}


# Tables that grow with time; the others are catalogues. By each the column whose ranges split a read of it: its key
# or, where a table has none, the key of the table it belongs to or the instant of its rows.
GROWING = {
    "hpnestanc": "hesfecing",
    "genpacien": "oid",
    "adningreso": "oid",
    "adnegreso": "oid",
    "adndiaegr": "adnegreso",
    "slnserpro": "oid",
    "slnprohoj": "oid",
    "inncsumpa": "oid",
    "innmsumpa": "slnprohoj",
    "slnserhoj": "oid",
    "genmanser": "oid",
    "genmantar": "oid",
    "slnordser": "oid",
    "slnfactur": "oid",
    "crnradfacd": "slnfactur",
    "crnradfacc": "oid",
    "crnmtrasl": "crnctrasl",
    "crnctrasl": "oid",
    "crncxc": "oid",
    "cmncitmed": "oid",
    "hcnfolio": "oid",
    "hcnrefer": "hcnfolio",
    "hcntriage": "oid",
    "hcninyacc": "oid",
    "hcniyaevts": "InsidentesAccidentes",
}


def schema(name: str) -> StructType:
    fields = [f.strip().rsplit(" ", 1) for f in TABLES[name].split(",")]
    return StructType([StructField(column, _TYPES[kind]) for column, kind in fields])
