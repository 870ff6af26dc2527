"""Coded values of the hospital tables and their printed labels."""

# The labels have to read exactly like this in the reports.

BED_STATE = {
    0: "Ninguno",
    1: "Desocupada",
    2: "Ocupada",
    3: "Bloqueada",
    4: "Desbloqueada",
    5: "Mantenimiento",
    6: "Inactiva",
}

DOCUMENT_TYPE = {
    0: "Ninguno",
    1: "Cédula de ciudadanía",
    2: "Cédula de extranjería",
    3: "Tarjeta de identidad",
    4: "Registro civil",
    5: "Pasaporte",
    6: "Adulto sin identificación",
    7: "Menor sin identificación",
    8: "Número único de identificación",
    9: "Salvoconducto",
    10: "Certificado nacido vivo",
    11: "Carné Diplomático",
    12: "Permiso Especial de Permanencia",
    14: "Permiso por protección temporal",
    15: "Documento de identificación extranjero",
}

PLAN_TYPE = {
    0: "Ninguno",
    1: "Subsidiado",
    2: "Vinculado",
    3: "Contributivo",
    4: "Particular",
    5: "AccidenteTransito",
    6: "Otros",
    7: "IPSPrivada",
    8: "EmpresaRegimenEspecial",
    9: "FOSYGATraumaMayor",
    10: "EventosCatastroficos",
    11: "CompañiasAseguradoras",
    12: "Desplazados",
    13: "ConvenioUCI",
}

ADMISSION_TYPE = {0: "Ninguno", 1: "Ambulatorio", 2: "Hospitalario"}

ADMISSION_STATE = {
    0: "Registrado",
    1: "Facturado",
    2: "Anulado",
    3: "Bloqueado",
    4: "Cerrado",
}

ADMISSION_ORIGIN = {
    -1: "Ninguno",
    0: "Urgencias",
    1: "Consulta_Externa",
    2: "Nacido_Hospital",
    3: "Remitido",
    4: "Hosp_Urgencias",
    5: "Hospitalizacion",
    6: "Imagenes",
    7: "Laboratorio",
    8: "Urgencia_Ginecologica",
    9: "Quirofano",
    10: "Cirugia_Ambulatoria",
    11: "Cirugia_Programada",
    12: "Uci_Neonatal",
    13: "Uci_Adulto",
}

ADMISSION_CAUSE = {
    0: "Ninguna",
    1: "Enfermedad_Profesional",
    2: "Heridos_en_Combate",
    3: "Enfermedad_General_Adulto",
    4: "Enfermedad_General_Pediatria",
    5: "Odontología",
    6: "Accidente_de_Transito",
    7: "Catastrofe_Fisalud",
    8: "Quemados",
    9: "Maternidad",
    10: "Accidente_Laboral",
    11: "Cirugia_Programada",
}

RISK_TYPE = {
    0: "Ninguna",
    1: "Accidente_de_Transito",
    2: "Catastrofe",
    3: "Enfermedad_General_y_Maternidad",
    4: "Accidente_de_Trabajo",
    5: "Enfermedad_Profesional",
    6: "Atención_Inicial_de_Urgencias",
    7: "Otro_Tipo_de_Accidente",
    8: "Lesión_por_Agresión",
    9: "Lesión_Autoinfligida",
    10: "Maltrato_Físico",
    11: "Promoción_y_Prevención",
    12: "Otro",
    13: "Accidente_Rábico",
    14: "Accidente_Ofídico",
    15: "Sospecha_de_Abuso_Sexual",
    16: "Sospecha_de_Violencia_Sexual",
    17: "Sospecha_de_Maltrato_Emocional",
}

FILING_STATE = {
    -1: "No Registrado",
    0: "Registrado",
    1: "Confirmado",
    2: "Radicado Entidad",
    3: "Anulado",
}

INVOICE_TYPE = {
    "0": "Factura_Paciente",
    "1": "Factura_Entidad",
    "2": "Factura_CapitadaEstatal",
    "5": "CuentaCobro_EntidadCapitada",
    "6": "Factura_EntidadCapitada",
    "7": "Factura_Global",
    "8": "CuentaCobro_PFGP",
    "16": "Factura_GlobalPFGP",
}

CONSULTATION_TYPE = {0: "Ninguna", 1: "General", 2: "Especializada"}

APPOINTMENT_STATE = {
    0: "ASIGNADA",
    1: "CANCELADA",
    2: "CUMPLIDA",
    3: "INCUMPLIDA",
    4: "FACTURADA",
    5: "INATENCION",
}

# Indicator 02 ends in a blank, and 13 carries its own remark.
EMERGENCY_INDICATORS = {
    "01": "01. NUMERO DE CAMILLA DEL SERVICIO DE URGENCIAS",
    "02": "02. NUMERO DE CONSULTORIOS PARA LA ATENCION DE URGENCIAS ",
    "03": "03. NUMERO DE CONSULTAS O INGRESOS AL SERVICIO DE URGENCIA GENERAL (INCLUYE REANIMACION)",
    "04": "04. NRO CAMAS DE OBSERVACION",
    "05H": "05. NUMEROS DE PACIENTES EN OBSERVACION ADULTOS HOMBRES",
    "05M": "05. NUMEROS DE PACIENTES EN OBSERVACION ADULTOS MUJERES",
    "06": "06. NUMERO DE PACIENTES VIVOS EGRESADOS POR URGENCIAS",
    "07": "07. CONSULTAS ",
    "08": "08. CONSULTAS PRIORITARIAS (PACIENTES CON TRIAGE 3 O 4)",
    "09": "09. PACIENTES QUE PASARON A HOSPITALIZACION",
    "10": "10. NUMERO DE INFECCIONES ASOCIADAS AL PROCESO DE ATENCIÓN",
    "11": "11. ACCIDENTE OFIDICO",
    "12": "12. TERAPIAS RESPIRATORIAS",
    "13": "13. Total Urgencia Ginecológica (REVISAR)",
    "14": "14. MORTALIDAD POR URGENCIAS",
    "15": "15. NUMERO DE REMISIONES",
}

DRUGS = "MEDICAMENTOS"
OCCUPIED, FREE = "Ocupada", "Desocupada"
BILLED, PENDING = "FACTURADO", "PENDIENTE"
FLOOR_CLASS = "HOSPITALIZACION"
FLOOR_ENTRY, FLOOR_EXIT = "INGRESO A PISO", "EGRESO DE PISO"

# Invoice document types that never count as an invoice to collect.
EXCLUDED_INVOICE_TYPES = (3, 4, 9, 10, 11, 12, 13, 14, 15)

# Words that end (or begin) an area name, in the order in which they are tried.
AREA_MARKERS = ("CACE", "CACR", "SEDE")

# First instant covered by the admissions, invoices and sales reports.
REPORT_START = "2021-10-31 00:00:00"

# First day of the daily histories, and year of the service history.
SPINE_START = "2022-11-01"
HISTORY_YEAR = 2022
