"""Sea water by the EOS-80 polynomials, as Columns (N1-N6). Pressures in dbar, depths in m, salinities practical."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the UNESCO 1983 algorithms (technical papers in marine science 44), lowest power first.
SMOW = (999.842594, 6.793952e-2, -9.095290e-3, 1.001685e-4, -1.120083e-6, 6.536332e-9)
RHO_S = (8.24493e-1, -4.0899e-3, 7.6438e-5, -8.2467e-7, 5.3875e-9)
RHO_S15 = (-5.72466e-3, 1.0227e-4, -1.6546e-6)
RHO_S2 = 4.8314e-4
KW = (19652.21, 148.4206, -2.327105, 1.360477e-2, -5.155288e-5)
K_S = (54.6746, -0.603459, 1.09987e-2, -6.1670e-5)
K_S15 = (7.944e-2, 1.6483e-2, -5.3009e-4)
AW = (3.239908, 1.43713e-3, 1.16092e-4, -5.77905e-7)
A_S = (2.2838e-3, -1.0981e-5, -1.6078e-6)
A_S15 = 1.91075e-4
BW = (8.50935e-5, -6.12293e-6, 5.2787e-8)
B_S = (-9.9348e-7, 2.0816e-8, 9.1697e-10)
DEPTH = (9.72659, -2.2512e-5, 2.279e-10, -1.82e-15)
T68_PER_T90 = 1.00024


def horner(coefficients: tuple[float, ...], x: Column) -> Column:
    out = F.lit(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        out = F.lit(c) + out * x
    return out


def gravity(lat: Column) -> Column:
    s = F.pow(F.sin(F.radians(F.abs(lat))), 2)
    return 9.780318 * (1 + (5.2788e-3 + 2.36e-5 * s) * s)


def depth(pressure: Column, lat: Column) -> Column:
    return horner(DEPTH, pressure) * pressure / (gravity(lat) + 1.092e-6 * pressure)


def pressure(depth_m: Column, lat: Column) -> Column:
    s = F.sin(F.radians(F.abs(lat)))
    c = 1 - (5.92e-3 + s * s * 5.25e-3)
    return (c - F.sqrt(c * c - 8.84e-6 * depth_m)) / 4.42e-6


def freezing_point(salinity: Column, pressure_dbar: Column) -> Column:
    """IPTS-68; null outside salinities from 4 to 40."""
    t = -7.53e-4 * pressure_dbar - 0.0575 * salinity + 1.710523e-3 * F.pow(salinity, F.lit(1.5)) - 2.154996e-4 * salinity * salinity
    return F.when(salinity.between(4, 40), t)


def smow_density(t68: Column) -> Column:
    return horner(SMOW, t68)


def surface_density(salinity: Column, t68: Column) -> Column:
    return smow_density(t68) + horner(RHO_S, t68) * salinity + horner(RHO_S15, t68) * F.pow(salinity, F.lit(1.5)) + RHO_S2 * salinity * salinity


def secant_bulk_modulus(salinity: Column, t68: Column, pressure_dbar: Column) -> Column:
    p, root = pressure_dbar / 10, F.sqrt(salinity)
    a = horner(AW, t68) + (horner(A_S, t68) + A_S15 * root) * salinity
    b = horner(BW, t68) + horner(B_S, t68) * salinity
    k = horner(KW, t68) + (horner(K_S, t68) + horner(K_S15, t68) * root) * salinity
    return k + (a + b * p) * p


def density(salinity: Column, t68: Column, pressure_dbar: Column) -> Column:
    return surface_density(salinity, t68) / (1 - pressure_dbar / 10 / secant_bulk_modulus(salinity, t68, pressure_dbar))


def temperature(t: Column, scale: str, to: str = "ITS-90") -> Column:
    """Between IPTS-48, IPTS-68 and ITS-90; 48 is only a source."""
    if scale == to:
        return t
    t68 = {"IPTS-48": t - 4.4e-6 * t * (100 - t), "IPTS-68": t, "ITS-90": t * T68_PER_T90}[scale]
    return {"IPTS-68": t68, "ITS-90": t68 / T68_PER_T90}[to]
