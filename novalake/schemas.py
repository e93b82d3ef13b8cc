"""Alert record types.

Names and types of the record fields are fixed values: they follow the
published alert format and are what the table plans read.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

_TYPES = {
    "long": LongType(),
    "int": IntegerType(),
    "double": DoubleType(),
    "float": FloatType(),
    "string": StringType(),
}


def _struct(spec: str) -> StructType:
    """``type: name name ...`` per line, in that order."""
    fields = []
    for line in spec.strip().splitlines():
        kind, names = line.split(":")
        fields += [StructField(n, _TYPES[kind.strip()]) for n in names.split()]
    return StructType(fields)


# Fields of `candidate`.
CANDIDATE = _struct("""
    long: candid pid rfid objectidps1 objectidps2 objectidps3
    double: jd ra dec ranr decnr jdstartref jdendref scorr
    int: fid nid nneg nbad nmatches rcid field nframesref nmtchps
    string: isdiffpos rbversion drbversion ssnamenr
    float: diffmaglim xpos ypos magpsf sigmapsf chipsf magap sigmagap distnr sky fwhm classtar
    float: mindtoedge seeratio aimage bimage aimagerat bimagerat rb drb sumrat magapbig sigmagapbig
    float: dsnrms ssnrms magzpsci magzpsciunc magzpscirms clrcoeff clrcounc zpclrcov zpmed clrmed
    float: clrrms exptime magnr sigmagnr chinr sharpnr
    float: neargaia neargaiabright maggaia maggaiabright ssdistnr ssmagnr
    float: sgmag1 srmag1 simag1 szmag1 sgscore1 distpsnr1
    float: sgmag2 srmag2 simag2 szmag2 sgscore2 distpsnr2
    float: sgmag3 srmag3 simag3 szmag3 sgscore3 distpsnr3
""")

# Fields of an element of `prv_candidates`.
HISTORY = _struct("""
    long: candid pid
    double: jd ra dec scorr
    int: fid nid nneg nbad rcid field
    string: isdiffpos rbversion
    float: diffmaglim xpos ypos magpsf sigmapsf chipsf magap sigmagap distnr sky fwhm classtar
    float: mindtoedge seeratio aimage bimage aimagerat bimagerat rb sumrat magapbig sigmagapbig
    float: magzpsci magzpsciunc magzpscirms clrcoeff clrcounc
""")

# Fields of an element of `fp_hists`.
FORCED = _struct("""
    string: procstatus
    double: jd ranr decnr
    int: field rcid fid
    long: pid rfid
    float: sciinpseeing scibckgnd scisigpix magzpsci magzpsciunc magzpscirms clrcoeff clrcounc
    float: exptime adpctdif1 adpctdif2 diffmaglim forcediffimflux forcediffimfluxunc distnr
    float: magnr sigmagnr chinr sharpnr
""")

ALERT = StructType([
    StructField("objectId", StringType()),
    StructField("candid", LongType()),
    StructField("candidate", CANDIDATE),
    StructField("prv_candidates", ArrayType(HISTORY)),
    StructField("fp_hists", ArrayType(FORCED)),
    StructField("observation_date", DateType()),
])

STAMP = StructType([
    StructField("fileName", StringType()),
    StructField("stampData", BinaryType()),
])

# Payload fields of a landing record.
STAMP_FIELDS = ["cutoutScience", "cutoutTemplate", "cutoutDifference"]

LANDING = StructType(
    ALERT.fields[:-1]
    + [StructField(n, STAMP) for n in STAMP_FIELDS]
    + ALERT.fields[-1:]
)
