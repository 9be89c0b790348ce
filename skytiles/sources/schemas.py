"""Declared schemas of the two catalogue tables (Source and Object).

The catalogue files are header-less CSV, so columns are positional. The
column order, names, Spark types and NOT NULL flags below are the
catalogue's DDL, restated with Spark type names.

DDL to Spark type mapping: NUMBER(p,0) is ``bigint`` for p >= 10, ``int``
for 5 <= p < 10 and ``smallint`` below; FLOAT(24) and float are
``double`` (values carry 17 significant digits); char(n) is ``string``.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "smallint": T.ShortType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
}

# --- Fixed values: Source table layout, 107 columns, in file order. ---
SOURCE_COLUMNS = """
sourceId bigint not null
scienceCcdExposureId bigint
filterId smallint not null
objectId bigint
movingObjectId bigint
procHistoryId bigint not null
ra double not null
raSigmaForDetection double
raSigmaForWcs double not null
decl double not null
declSigmaForDetection double
declSigmaForWcs double not null
htmId20 bigint not null
xFlux double
xFluxSigma double
yFlux double
yFluxSigma double
raFlux double
raFluxSigma double
declFlux double
declFluxSigma double
xPeak double
yPeak double
raPeak double
declPeak double
xAstrom double
xAstromSigma double
yAstrom double
yAstromSigma double
raAstrom double
raAstromSigma double
declAstrom double
declAstromSigma double
raObject double
declObject double
taiMidPoint double not null
taiRange double
psfFlux double
psfFluxSigma double
apFlux double
apFluxSigma double
modelFlux double
modelFluxSigma double
petroFlux double
petroFluxSigma double
instFlux double
instFluxSigma double
nonGrayCorrFlux double
nonGrayCorrFluxSigma double
atmCorrFlux double
atmCorrFluxSigma double
apDia double
Ixx double
IxxSigma double
Iyy double
IyySigma double
Ixy double
IxySigma double
psfIxx double
psfIxxSigma double
psfIyy double
psfIyySigma double
psfIxy double
psfIxySigma double
e1_SG double
e1_SG_Sigma double
e2_SG double
e2_SG_Sigma double
resolution_SG double
shear1_SG double
shear1_SG_Sigma double
shear2_SG double
shear2_SG_Sigma double
sourceWidth_SG double
sourceWidth_SG_Sigma double
shapeFlag_SG int
snr double not null
chi2 double not null
sky double
skySigma double
extendedness int
flux_Gaussian double
flux_Gaussian_Sigma double
flux_ESG double
flux_ESG_Sigma double
sersicN_SG double
sersicN_SG_Sigma double
radius_SG double
radius_SG_Sigma double
flux_flux_SG_Cov double
flux_e1_SG_Cov double
flux_e2_SG_Cov double
flux_radius_SG_Cov double
flux_sersicN_SG_Cov double
e1_e1_SG_Cov double
e1_e2_SG_Cov double
e1_radius_SG_Cov double
e1_sersicN_SG_Cov double
e2_e2_SG_Cov double
e2_radius_SG_Cov double
e2_sersicN_SG_Cov double
radius_radius_SG_Cov double
radius_sersicN_SG_Cov double
sersicN_sersicN_SG_Cov double
flagForAssociation int
flagForDetection bigint
flagForWcs int
"""

# --- Fixed values: Object table layout (229 columns). ---
# 29 leading columns, then one block of 33 columns for each photometric
# band (prefixed by the band letter), then two trailing columns.
OBJECT_LEADING_COLUMNS = """
objectId bigint not null
iauId string
ra_PS double not null
ra_PS_Sigma double
decl_PS double not null
decl_PS_Sigma double
radecl_PS_Cov double
htmId20 bigint not null
ra_SG double
ra_SG_Sigma double
decl_SG double
decl_SG_Sigma double
radecl_SG_Cov double
raRange double
declRange double
muRa_PS double
muRa_PS_Sigma double
muDecl_PS double
muDecl_PS_Sigma double
muRaDecl_PS_Cov double
parallax_PS double
parallax_PS_Sigma double
canonicalFilterId smallint
extendedness int
varProb double
earliestObsTime double
latestObsTime double
meanObsTime double
flags bigint
"""

OBJECT_BANDS = "ugrizy"

OBJECT_BAND_COLUMNS = """
NumObs bigint
Extendedness int
VarProb double
RaOffset_PS double
RaOffset_PS_Sigma double
DeclOffset_PS double
DeclOffset_PS_Sigma double
RaDeclOffset_PS_Cov double
RaOffset_SG double
RaOffset_SG_Sigma double
DeclOffset_SG double
DeclOffset_SG_Sigma double
RaDeclOffset_SG_Cov double
LnL_PS double
LnL_SG double
Flux_PS double
Flux_PS_Sigma double
Flux_ESG double
Flux_ESG_Sigma double
Flux_Gaussian double
Flux_Gaussian_Sigma double
Timescale double
EarliestObsTime double
LatestObsTime double
SersicN_SG double
SersicN_SG_Sigma double
E1_SG double
E1_SG_Sigma double
E2_SG double
E2_SG_Sigma double
Radius_SG double
Radius_SG_Sigma double
Flags bigint
"""

OBJECT_TRAILING_COLUMNS = """
chunkId bigint
subChunkId bigint
"""


def _fields(spec: str, prefix: str = "") -> list[T.StructField]:
    out = []
    for line in spec.strip().splitlines():
        name, typ, *flags = line.split()
        out.append(T.StructField(prefix + name, _TYPES[typ], nullable=not flags))
    return out


def source_schema() -> T.StructType:
    """Spark schema of the Source (detection) table."""
    return T.StructType(_fields(SOURCE_COLUMNS))


def object_schema() -> T.StructType:
    """Spark schema of the Object table: leading, per-band blocks, trailing."""
    fields = _fields(OBJECT_LEADING_COLUMNS)
    for band in OBJECT_BANDS:
        fields += _fields(OBJECT_BAND_COLUMNS, prefix=band)
    fields += _fields(OBJECT_TRAILING_COLUMNS)
    return T.StructType(fields)


def column_index(schema: T.StructType, name: str) -> int:
    """Position of a column in a header-less file laid out by ``schema``."""
    return schema.fieldNames().index(name)


# Columns the spatial operators work on, with the points-view names.
SOURCE_POINT_COLUMNS = {
    "sourceId": "source_id",
    "objectId": "object_id",
    "ra": "ra",
    "decl": "decl",
}
