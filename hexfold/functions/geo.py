"""Projections, hexagon geometry and small spatial predicates, as Column expressions."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: WGS84 and the UTM scale and false easting
AXIS, FLATTENING, SCALE, EASTING = 6378137.0, 1 / 298.257223563, 0.9996, 500000.0
_n = FLATTENING / (2 - FLATTENING)
_RADIUS = AXIS / (1 + _n) * (1 + _n**2 / 4 + _n**4 / 64)
# fixed values: third-order Krueger series
ALPHA = (_n / 2 - 2 * _n**2 / 3 + 5 * _n**3 / 16, 13 * _n**2 / 48 - 3 * _n**3 / 5, 61 * _n**3 / 240)
BETA = (_n / 2 - 2 * _n**2 / 3 + 37 * _n**3 / 96, _n**2 / 48 + _n**3 / 15, 17 * _n**3 / 480)
DELTA = (2 * _n - 2 * _n**2 / 3 - 2 * _n**3, 7 * _n**2 / 3 - 8 * _n**3 / 5, 56 * _n**3 / 15)
KM_PER_DEGREE = 111.32


def utm_meridian(lon: float) -> float:
    """Central meridian of the zone that holds a longitude."""
    return math.floor((lon + 180) / 6) * 6 - 177.0


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def utm(lon: Column, lat: Column, meridian: float) -> Column:
    """struct(x, y): easting and northing in metres (no southern offset)."""
    e = 2 * math.sqrt(_n) / (1 + _n)
    sin, far = F.sin(F.radians(lat)), F.radians(lon - meridian)

    def series(s):
        x, y = s["eta"], s["xi"]
        for j, a in enumerate(ALPHA, 1):
            x = x + a * F.cos(2 * j * s["xi"]) * F.sinh(2 * j * s["eta"])
            y = y + a * F.sin(2 * j * s["xi"]) * F.cosh(2 * j * s["eta"])
        return F.struct((EASTING + SCALE * _RADIUS * x).alias("x"), (SCALE * _RADIUS * y).alias("y"))

    def sphere(s):
        eta = F.atanh(F.sin(s["far"]) / F.sqrt(1 + s["t"] * s["t"]))
        return let(F.struct(F.atan2(s["t"], F.cos(s["far"])).alias("xi"), eta.alias("eta")), series)

    return let(F.struct(F.sinh(F.atanh(sin) - e * F.atanh(e * sin)).alias("t"), far.alias("far")), sphere)


def from_utm(x: Column, y: Column, meridian: float) -> tuple[Column, Column]:
    """Longitude and latitude in degrees."""

    def sphere(p):
        a, b = p["xi"], p["eta"]
        for j, c in enumerate(BETA, 1):
            a = a - c * F.sin(2 * j * p["xi"]) * F.cosh(2 * j * p["eta"])
            b = b - c * F.cos(2 * j * p["xi"]) * F.sinh(2 * j * p["eta"])
        return let(F.struct(a.alias("a"), b.alias("b")), lambda s: let(F.struct(F.asin(F.sin(s["a"]) / F.cosh(s["b"])).alias("chi"), F.atan2(F.sinh(s["b"]), F.cos(s["a"])).alias("far")), earth))

    def earth(s):
        lat = s["chi"]
        for j, c in enumerate(DELTA, 1):
            lat = lat + c * F.sin(2 * j * s["chi"])
        return F.struct((meridian + F.degrees(s["far"])).alias("lon"), F.degrees(lat).alias("lat"))

    at = let(F.struct((y / (SCALE * _RADIUS)).alias("xi"), ((x - EASTING) / (SCALE * _RADIUS)).alias("eta")), sphere)
    return at["lon"], at["lat"]


@dataclass(frozen=True)
class Cone:
    """A Lambert conformal conic projection with two standard parallels, on WGS84; metres from its origin."""

    meridian: float
    n: float
    scale: float
    origin: float

    def forward(self, lon: Column, lat: Column) -> Column:
        """struct(x, y)."""
        e = math.sqrt(FLATTENING * (2 - FLATTENING))
        sin = F.sin(F.radians(lat))
        rho = self.scale * F.exp(-self.n * (F.atanh(sin) - e * F.atanh(e * sin)))
        turn = self.n * F.radians(lon - self.meridian)
        return let(F.struct(rho.alias("rho"), turn.alias("turn")), lambda s: F.struct((s["rho"] * F.sin(s["turn"])).alias("x"), (self.origin - s["rho"] * F.cos(s["turn"])).alias("y")))

    def inverse(self, x: Column, y: Column) -> tuple[Column, Column]:
        """Longitude and latitude in degrees."""
        down = self.origin - y
        # the isometric latitude gives the conformal one, and its series the latitude
        chi = F.atan(F.sinh(-F.log(F.hypot(x, down) / self.scale) / self.n))

        def earth(s):
            lat = s["chi"]
            for j, c in enumerate(DELTA, 1):
                lat = lat + c * F.sin(2 * j * s["chi"])
            return lat

        return self.meridian + F.degrees(F.atan2(x, down)) / self.n, F.degrees(let(F.struct(chi.alias("chi")), earth))


def lambert(lon: float, lat: float, south: float, north: float) -> Cone:
    """The cone of an origin and two different parallels of one hemisphere (the north)."""
    e = math.sqrt(FLATTENING * (2 - FLATTENING))
    psi = lambda at: math.atanh(math.sin(math.radians(at))) - e * math.atanh(e * math.sin(math.radians(at)))
    across = lambda at: math.cos(math.radians(at)) / math.sqrt(1 - (e * math.sin(math.radians(at))) ** 2)
    n = math.log(across(south) / across(north)) / (psi(north) - psi(south))
    scale = AXIS * across(south) * math.exp(n * psi(south)) / n
    return Cone(lon, n, scale, scale * math.exp(-n * psi(lat)))


def select_projection(x0: float, y0: float, x1: float, y1: float) -> tuple[str, tuple[float, ...]]:
    """Kind and parameters for a frame, by the greater of its extents in kilometres.

    Under 200: ("utm", central meridian); under 2000: ("lcc", longitude,
    latitude, parallels); else ("aeqd", longitude, latitude).
    """
    lon, lat = (x0 + x1) / 2, (y0 + y1) / 2
    extent = max((y1 - y0) * KM_PER_DEGREE, (x1 - x0) * KM_PER_DEGREE * math.cos(math.radians(lat)))
    if extent < 200:
        return "utm", (utm_meridian(lon),)
    if extent < 2000:
        return "lcc", tuple(round(v, 2) for v in (lon, lat, y0 + (y1 - y0) / 6, y1 - (y1 - y0) / 6))
    return "aeqd", (round(lon, 2), round(lat, 2))


def project(df: DataFrame, projection: tuple[str, tuple[float, ...]], lon: str = "lon", lat: str = "lat") -> DataFrame:
    """``df`` with x and y in metres, under a ``select_projection``; steps are columns, so that each is computed once."""
    kind, at = projection
    if kind == "utm":
        e = 2 * math.sqrt(_n) / (1 + _n)
        df = df.withColumns({"_s": F.sin(F.radians(lat)), "_f": F.radians(F.col(lon) - at[0])})
        df = df.withColumn("_t", F.sinh(F.atanh("_s") - e * F.atanh(e * F.col("_s"))))
        df = df.withColumns({"_xi": F.atan2(F.col("_t"), F.cos("_f")), "_eta": F.atanh(F.sin("_f") / F.sqrt(1 + F.col("_t") * F.col("_t")))})
        x, y = F.col("_eta"), F.col("_xi")
        for j, a in enumerate(ALPHA, 1):
            x = x + a * F.cos(2 * j * F.col("_xi")) * F.sinh(2 * j * F.col("_eta"))
            y = y + a * F.sin(2 * j * F.col("_xi")) * F.cosh(2 * j * F.col("_eta"))
        return fenced(df, x=EASTING + SCALE * _RADIUS * x, y=SCALE * _RADIUS * y).drop("_s", "_f", "_t", "_xi", "_eta")
    if kind == "lcc":
        cone = lambert(*at)
        e = math.sqrt(FLATTENING * (2 - FLATTENING))
        df = df.withColumn("_s", F.sin(F.radians(lat)))
        df = df.withColumns({"_rho": cone.scale * F.exp(-cone.n * (F.atanh("_s") - e * F.atanh(e * F.col("_s")))), "_turn": cone.n * F.radians(F.col(lon) - cone.meridian)})
        return fenced(df, x=F.col("_rho") * F.sin("_turn"), y=cone.origin - F.col("_rho") * F.cos("_turn")).drop("_s", "_rho", "_turn")
    return _azimuthal(df, at, lon, lat)


def unproject(df: DataFrame, projection: tuple[str, tuple[float, ...]], x: str = "x", y: str = "y") -> DataFrame:
    """``df`` with lon and lat in degrees of the points x, y."""
    kind, at = projection
    if kind == "utm":
        df = df.withColumns({"_xi": F.col(y) / (SCALE * _RADIUS), "_eta": (F.col(x) - EASTING) / (SCALE * _RADIUS)})
        a, b = F.col("_xi"), F.col("_eta")
        for j, c in enumerate(BETA, 1):
            a = a - c * F.sin(2 * j * F.col("_xi")) * F.cosh(2 * j * F.col("_eta"))
            b = b - c * F.cos(2 * j * F.col("_xi")) * F.sinh(2 * j * F.col("_eta"))
        df = df.withColumns({"_a": a, "_b": b})
        df = df.withColumns({"_chi": F.asin(F.sin("_a") / F.cosh("_b")), "_lon": at[0] + F.degrees(F.atan2(F.sinh("_b"), F.cos("_a")))})
        return _geographic(df).drop("_xi", "_eta", "_a", "_b", "_chi", "_lon")
    if kind == "lcc":
        cone = lambert(*at)
        df = df.withColumn("_down", cone.origin - F.col(y))
        df = df.withColumns({"_chi": F.atan(F.sinh(-F.log(F.hypot(F.col(x), F.col("_down")) / cone.scale) / cone.n)), "_lon": cone.meridian + F.degrees(F.atan2(F.col(x), F.col("_down"))) / cone.n})
        return _geographic(df).drop("_down", "_chi", "_lon")
    return _from_azimuthal(df, at, x, y)


def _geographic(df: DataFrame) -> DataFrame:
    """Latitude from the conformal one, by its series."""
    lat = F.col("_chi")
    for j, c in enumerate(DELTA, 1):
        lat = lat + c * F.sin(2 * j * F.col("_chi"))
    return fenced(df, lon=F.col("_lon"), lat=F.degrees(lat))


POLAR = AXIS * (1 - FLATTENING)
ROUNDS = 5  #: of the geodesic's series; four leave under a millimetre at 3000 km


def fenced(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with columns made in one place: a later filter on them is not taken apart into the steps before."""
    return df.drop(*columns).select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def _series(df: DataFrame) -> DataFrame:
    """Coefficients of a geodesic's length, by the squared cosine of its azimuth at the equator."""
    df = df.withColumn("_u", F.col("_ca") * ((AXIS / POLAR) ** 2 - 1))
    u = F.col("_u")
    return df.withColumns({"_k1": 1 + u / 16384 * (4096 + u * (-768 + u * (320 - 175 * u))), "_k2": u / 1024 * (256 + u * (-128 + u * (74 - 47 * u)))})


def _shift() -> Column:
    """Difference of a geodesic's length on the ellipsoid from that on the sphere, as an angle."""
    b, mid, sin, cos = F.col("_k2"), F.col("_mid"), F.col("_sin"), F.col("_cos")
    return b * sin * (mid + b / 4 * (cos * (2 * mid * mid - 1) - b / 6 * mid * (4 * sin * sin - 3) * (4 * mid * mid - 3)))


def _turned() -> Column:
    """Difference of longitude on the sphere from that on the ellipsoid."""
    f, mid = FLATTENING, F.col("_mid")
    c = f / 16 * F.col("_ca") * (4 + f * (4 - 3 * F.col("_ca")))
    return (1 - c) * f * F.col("_sa") * (F.col("_angle") + c * F.col("_sin") * (mid + c * F.col("_cos") * (2 * mid * mid - 1)))


def _azimuthal(df: DataFrame, at: tuple[float, float], lon: str, lat: str) -> DataFrame:
    """Azimuthal equidistant on the ellipsoid: geodesic distance and azimuth from the centre (Vincenty's inverse formula)."""
    u = math.atan((1 - FLATTENING) * math.tan(math.radians(at[1])))
    s1, c1, given = math.sin(u), math.cos(u), df.columns
    df = df.withColumns({"_u2": F.atan((1 - FLATTENING) * F.tan(F.radians(lat))), "_far": F.radians(F.col(lon) - at[0])})
    df = df.withColumns({"_s2": F.sin("_u2"), "_c2": F.cos("_u2"), "_turn": F.col("_far")})
    for _ in range(ROUNDS):
        df = df.withColumns({"_st": F.sin("_turn"), "_ct": F.cos("_turn")})
        df = df.withColumns({"_px": F.col("_c2") * F.col("_st"), "_py": c1 * F.col("_s2") - s1 * F.col("_c2") * F.col("_ct"), "_cos": s1 * F.col("_s2") + c1 * F.col("_c2") * F.col("_ct")})
        df = df.withColumn("_sin", F.hypot("_px", "_py"))
        df = df.withColumns({"_angle": F.atan2("_sin", "_cos"), "_sa": F.coalesce(F.try_divide(c1 * F.col("_px"), F.col("_sin")), F.lit(0.0))})
        df = df.withColumn("_ca", 1 - F.col("_sa") * F.col("_sa"))
        df = df.withColumn("_mid", F.col("_cos") - F.coalesce(F.try_divide(2 * s1 * F.col("_s2"), F.col("_ca")), F.lit(0.0)))
        df = df.withColumn("_turn", F.col("_far") + _turned())
    df = _series(df)
    df = df.withColumns({"_d": POLAR * F.col("_k1") * (F.col("_angle") - _shift()), "_to": F.atan2("_px", "_py")})
    return fenced(df, x=F.col("_d") * F.sin("_to"), y=F.col("_d") * F.cos("_to")).select(*[c for c in given if c not in ("x", "y")], "x", "y")


def _from_azimuthal(df: DataFrame, at: tuple[float, float], x: str, y: str) -> DataFrame:
    """The point at a geodesic's distance and azimuth from the centre (Vincenty's direct formula)."""
    t1, given = (1 - FLATTENING) * math.tan(math.radians(at[1])), df.columns
    c1 = 1 / math.sqrt(1 + t1 * t1)
    s1 = t1 * c1
    df = df.withColumns({"_d": F.hypot(F.col(x), F.col(y)), "_to": F.atan2(F.col(x), F.col(y))})
    df = df.withColumns({"_sz": F.sin("_to"), "_cz": F.cos("_to")})
    df = df.withColumns({"_g": F.atan2(F.lit(t1), F.col("_cz")), "_sa": c1 * F.col("_sz")})
    df = _series(df.withColumn("_ca", 1 - F.col("_sa") * F.col("_sa"))).withColumn("_whole", F.col("_d") / (POLAR * F.col("_k1")))
    df = df.withColumn("_angle", F.col("_whole"))
    for turn in range(ROUNDS + 1):
        df = df.withColumns({"_mid": F.cos(2 * F.col("_g") + F.col("_angle")), "_sin": F.sin("_angle"), "_cos": F.cos("_angle")})
        if turn < ROUNDS:
            df = df.withColumn("_angle", F.col("_whole") + _shift())
    lat = F.atan2(s1 * F.col("_cos") + c1 * F.col("_sin") * F.col("_cz"), (1 - FLATTENING) * F.hypot(F.col("_sa"), s1 * F.col("_sin") - c1 * F.col("_cos") * F.col("_cz")))
    turn = F.atan2(F.col("_sin") * F.col("_sz"), c1 * F.col("_cos") - s1 * F.col("_sin") * F.col("_cz"))
    return fenced(df, lon=at[0] + F.degrees(turn - _turned()), lat=F.degrees(lat)).select(*[c for c in given if c not in ("lon", "lat")], "lon", "lat")


def box_from_center(lat: Column, lon: Column, width_km: Column, height_km: Column) -> tuple[Column, Column, Column, Column]:
    """min_lon, min_lat, max_lon, max_lat of a box by its centre and sizes."""
    half_w, half_h = width_km / 2 / (KM_PER_DEGREE * F.cos(F.radians(lat))), height_km / 2 / KM_PER_DEGREE
    return lon - half_w, lat - half_h, lon + half_w, lat + half_h


def box_center(x0: Column, y0: Column, x1: Column, y1: Column) -> tuple[Column, Column]:
    """lat, lon."""
    return (y0 + y1) / 2, (x0 + x1) / 2


def box_width_km(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return (x1 - x0) * KM_PER_DEGREE * F.cos(F.radians((y0 + y1) / 2))


def box_height_km(y0: Column, y1: Column) -> Column:
    return (y1 - y0) * KM_PER_DEGREE


def radius(size: float) -> float:
    """Centre to vertex of a hexagon whose opposite sides are ``size`` apart."""
    return size / math.sqrt(3)


def centre(q: Column, r: Column, size: float) -> tuple[Column, Column]:
    """Flat-top centre; odd columns stand half a row north."""
    return q * (1.5 * radius(size)), (r + F.pmod(q, F.lit(2)) * 0.5) * size


def point_to_hex(x: Column, y: Column, size: float) -> Column:
    """struct(q, r) of the nearest centre among the six candidates (ties: least q, r)."""
    pitch = 1.5 * radius(size)

    def nearest(p):
        found = []
        for dq in (-1, 0, 1):
            q = p["q"] + dq
            r0 = F.floor(p["y"] / size - F.pmod(q, F.lit(2)) * 0.5).cast("int")
            for dr in (0, 1):
                cx, cy = centre(q, r0 + dr, size)
                dx, dy = p["x"] - cx, p["y"] - cy
                found.append(F.struct((dx * dx + dy * dy).alias("d"), q.alias("q"), (r0 + dr).alias("r")))
        return let(F.least(*found), lambda b: F.struct(b["q"].alias("q"), b["r"].alias("r")))

    return let(F.struct(x.alias("x"), y.alias("y"), F.round(x / pitch).cast("int").alias("q")), nearest)


def place_in_hex(df: DataFrame, size: float, x: str = "x", y: str = "y") -> DataFrame:
    """``df`` with q and r of the hex that holds x, y, as ``point_to_hex``, in columns."""
    pitch = 1.5 * radius(size)
    df = df.withColumn("_q", F.round(F.col(x) / pitch).cast("int"))
    near = {-1: "_w", 0: "_c", 1: "_e"}
    df = df.withColumns({name: F.floor(F.col(y) / size - F.pmod(F.col("_q") + dq, F.lit(2)) * 0.5).cast("int") for dq, name in near.items()})
    spots = [(F.col("_q") + dq, F.col(name) + dr) for dq, name in near.items() for dr in (0, 1)]
    apart = []
    for q, r in spots:
        cx, cy = centre(q, r, size)
        dx, dy = F.col(x) - cx, F.col(y) - cy
        apart.append(dx * dx + dy * dy)
    names = [f"_d{i}" for i in range(len(spots))]
    df = df.withColumns(dict(zip(names, apart, strict=True))).withColumn("_m", F.least(*names))
    first = [F.col(name) == F.col("_m") for name in names[:-1]]  # of equal ones the least (q, r)

    def chosen(values: list[Column]) -> Column:
        out = F.when(first[0], values[0])
        for hit, value in zip(first[1:], values[1:-1], strict=True):
            out = out.when(hit, value)
        return out.otherwise(values[-1])

    return fenced(df, q=chosen([q for q, _ in spots]), r=chosen([r for _, r in spots])).drop("_q", "_m", *names, *near.values())


def vertices(cx: Column, cy: Column, size: float) -> Column:
    """Closed ring of seven vertices, counter-clockwise from east."""
    R = radius(size)
    return F.transform(F.sequence(F.lit(0), F.lit(6)), lambda i: F.struct((cx + R * F.cos(F.radians(i * 60.0))).alias("x"), (cy + R * F.sin(F.radians(i * 60.0))).alias("y")))


def neighbour_steps(q: Column) -> Column:
    """The six (dq, dr, edge) of a hex: edges 0 NE, 1 N, 2 NW, 3 SW, 4 S, 5 SE."""
    # fixed values: offsets of even and odd columns
    even = [(1, 0, 0), (0, 1, 1), (-1, 0, 2), (-1, -1, 3), (0, -1, 4), (1, -1, 5)]
    odd = [(1, 1, 0), (0, 1, 1), (-1, 1, 2), (-1, 0, 3), (0, -1, 4), (1, 0, 5)]
    steps = lambda t: F.array(*[F.struct(F.lit(a).alias("dq"), F.lit(b).alias("dr"), F.lit(e).alias("edge")) for a, b, e in t])
    return F.when(F.pmod(q, F.lit(2)) == 0, steps(even)).otherwise(steps(odd))


def hex_id(col: Column, row: Column) -> Column:
    return F.concat_ws("_", col.cast("string"), row.cast("string"))


def display_number(col: Column, row: Column, wide: bool) -> Column:
    """CCRR, or CCCRRR where a side has over 99 hexes."""
    return F.format_string("%03d%03d" if wide else "%02d%02d", col, row)


def tile(lon: Column, lat: Column) -> tuple[Column, Column]:
    return F.floor(lon).cast("int"), F.floor(lat).cast("int")


def overlaps(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Closed boxes (min_lon, min_lat, max_lon, max_lat) meet."""
    return (a[0] <= b[2]) & (b[0] <= a[2]) & (a[1] <= b[3]) & (b[1] <= a[3])


def crosses(x: Column, y: Column) -> Column:
    """The segment x1, y1, x2, y2 crosses the ray to the east of a point; half-open in y."""
    return ((F.col("y1") > y) != (F.col("y2") > y)) & (x < (F.col("x2") - F.col("x1")) * (y - F.col("y1")) / (F.col("y2") - F.col("y1")) + F.col("x1"))


def segment_distance(x: Column, y: Column) -> Column:
    """Distance of a point to the segment x1, y1, x2, y2."""
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    long = dx * dx + dy * dy
    t = F.when(long == 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((x - F.col("x1")) * dx + (y - F.col("y1")) * dy) / long)))
    ex, ey = x - F.col("x1") - t * dx, y - F.col("y1") - t * dy
    return F.sqrt(ex * ex + ey * ey)


def projection_kind(width_km: Column, height_km: Column) -> Column:
    """``select_projection``'s kind, of a column of frames."""
    extent = F.round(F.greatest(width_km, height_km), 6)
    return F.when(extent < 200, "utm").when(extent < 2000, "lcc").otherwise("aeqd")
