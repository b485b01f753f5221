"""Loads the geometry kernel (thin Java column functions over JTS) into a running Spark session.

JTS is already on Spark's own classpath, on the driver and on every executor. The kernel adds only the
glue classes: they are compiled once, shipped with ``ADD JAR`` and registered as session functions.

A cluster that has no ``javac`` on the driver can point the session setting ``spark.coverlay.kernel.jar``
at a jar built beforehand with :func:`build_jar` (any path Spark can read).
"""

from __future__ import annotations

import hashlib
import os
import shutil
import subprocess
import tempfile
import zipfile
from pathlib import Path

import pyspark
from py4j.protocol import Py4JError
from pyspark.sql import SparkSession
from pyspark.sql import types as T

_SRC = Path(__file__).parent / "java"
_JAR_SETTING = "spark.coverlay.kernel.jar"

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
BOUNDS = T.StructType([T.StructField(c, T.DoubleType()) for c in ("xmin", "ymin", "xmax", "ymax")])
NESTED = T.ArrayType(T.ArrayType(T.ArrayType(POINT)))
_BIN, _DBL, _INT, _BOOL, _STR = T.BinaryType(), T.DoubleType(), T.IntegerType(), T.BooleanType(), T.StringType()
_BINS = T.ArrayType(_BIN)
_PIECES = T.ArrayType(T.StructType([T.StructField("tile", T.LongType()), T.StructField("nested", NESTED)]))

#: SQL name -> (Java class, result type)
FUNCTIONS = {
    "cv_encode": ("Encode", _BIN),
    "cv_decode": ("Decode", NESTED),
    "cv_line": ("Line", _BIN),
    "cv_point": ("MakePoint", _BIN),
    "cv_box": ("Box", _BIN),
    "cv_from_text": ("FromText", _BIN),
    "cv_as_text": ("AsText", _STR),
    "cv_plain": ("Plain", _BIN),
    "cv_area": ("Area", _DBL),
    "cv_length": ("Length", _DBL),
    "cv_npoints": ("NumPoints", _INT),
    "cv_nparts": ("NumParts", _INT),
    "cv_is_valid": ("IsValid", _BOOL),
    "cv_is_empty": ("IsEmpty", _BOOL),
    "cv_bounds": ("Bounds", BOUNDS),
    "cv_centroid": ("CentroidOf", POINT),
    "cv_interior_point": ("InteriorPointOf", POINT),
    "cv_intersects": ("Intersects", _BOOL),
    "cv_within": ("Within", _BOOL),
    "cv_contains": ("Contains", _BOOL),
    "cv_touches": ("Touches", _BOOL),
    "cv_meets_inside": ("MeetsInside", _BOOL),
    "cv_intersection": ("Intersection", _BIN),
    "cv_difference": ("Difference", _BIN),
    "cv_union": ("Union", _BIN),
    "cv_near_part": ("NearPart", _BIN),
    "cv_polygonal_intersection": ("PolygonalIntersection", _BIN),
    "cv_frontage": ("Frontage", _DBL),
    "cv_within_distance": ("WithinDistance", _BOOL),
    "cv_contact_points": ("ContactPoints", T.ArrayType(POINT)),
    "cv_nearest_point": ("NearestPoint", POINT),
    "cv_split": ("Split", _BINS),
    "cv_polygonize": ("Polygonize", _BINS),
    "cv_faces_inside": ("FacesInside", _BINS),
    "cv_buffer": ("Buffer", _BIN),
    "cv_buffer_flat": ("BufferFlat", _BIN),
    "cv_chop": ("Chop", _BINS),
    "cv_make_valid": ("MakeValid", _BIN),
    "cv_simplify_dp": ("SimplifyDP", _BIN),
    "cv_simplify_vw": ("SimplifyVW", _BIN),
    "cv_simplify_topology": ("SimplifyTopology", _BIN),
    "cv_snap_to_grid": ("SnapToGrid", _BIN),
    "cv_boundary": ("Boundary", _BIN),
    "cv_fill_holes": ("FillHoles", _BIN),
    "cv_parts": ("Parts", _BINS),
    "cv_polygons": ("Polygons", _BINS),
    "cv_subdivide": ("Subdivide", _BINS),
    "cv_cut_rows": ("CutRows", _PIECES),
    "cv_cut_tile": ("CutTile", _PIECES),
}
AGGREGATES = {"cv_union_agg": "UnionAgg", "cv_collect_agg": "CollectAgg"}


class KernelUnavailable(RuntimeError):
    """The geometry kernel could not be built or loaded; plain DataFrame operators still work."""


#: One class of each library that the kernel is compiled against.
_NEEDS = ("org.apache.spark.sql.api.java.UDF1", "org.apache.spark.sql.expressions.Aggregator",
          "org.locationtech.jts.geom.Geometry", "scala.collection.Seq", "org.apache.spark.sql.Row")


def _running_class_path(spark: SparkSession) -> list[str]:
    """What the session's own JVM has loaded these classes from, and its class path."""
    jvm = spark.sparkContext._jvm
    loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
    found = []
    for name in _NEEDS:
        try:
            found.append(loader.loadClass(name).getProtectionDomain().getCodeSource().getLocation().getPath())
        except Py4JError:  # other folders may still hold it
            continue
    return [*found, *(jvm.java.lang.System.getProperty("java.class.path") or "").split(os.pathsep)]


def _holds(entry: str, member: str) -> bool:
    if os.path.isdir(entry):
        return os.path.exists(os.path.join(entry, member))
    try:
        with zipfile.ZipFile(entry) as zf:
            return member in zf.NameToInfo
    except (OSError, zipfile.BadZipFile):
        return False


def class_path(spark: SparkSession | None = None) -> str:
    """Class path for ``javac``: of the running JVM, then ``SPARK_HOME/jars``, then PySpark's own ``jars``."""
    entries = _running_class_path(spark) if spark is not None else []
    folders = [os.path.join(home, "jars") for home in (os.environ.get("SPARK_HOME"), os.path.dirname(pyspark.__file__)) if home]
    folders += [e[:-2] for e in entries if e.endswith("/*")]
    entries += [str(p) for f in folders for p in sorted(Path(f).glob("*.jar"))]
    entries = list(dict.fromkeys(e for e in entries if e and not e.endswith("/*") and os.path.exists(e)))
    missing = [c for c in _NEEDS if not any(_holds(e, c.replace(".", "/") + ".class") for e in entries)]
    if missing:
        raise KernelUnavailable(f"{', '.join(missing)} not found; searched the session's class path and {folders}")
    return os.pathsep.join(entries)


def build_jar(target_dir: str | os.PathLike | None = None, spark: SparkSession | None = None) -> str:
    """Compile the kernel against Spark's own jars and return the jar's path (reused when unchanged)."""
    sources = sorted(_SRC.rglob("*.java"))
    digest = hashlib.sha256(b"".join(p.read_bytes() for p in sources) + pyspark.__version__.encode()).hexdigest()[:16]
    target = Path(target_dir) if target_dir else Path(__file__).parent / "_build"
    try:
        target.mkdir(parents=True, exist_ok=True)
        if not os.access(target, os.W_OK):
            raise PermissionError(target)
    except OSError:
        target = Path(tempfile.mkdtemp(prefix="coverlay-kernel-"))  # code is loaded from it: private
    jar = target / f"coverlay-kernel-{digest}.jar"
    if jar.exists():
        return str(jar)
    javac = shutil.which("javac") or os.path.join(os.environ.get("JAVA_HOME", ""), "bin", "javac")
    if not os.path.exists(javac):
        raise KernelUnavailable(
            f"javac not found: geometry overlay operators need it, or a prebuilt jar named by {_JAR_SETTING}"
        )
    path = class_path(spark)
    with tempfile.TemporaryDirectory() as out:
        cmd = [javac, "-nowarn", "-Xlint:none", "-encoding", "UTF-8", "--release", "17", "-d", out, *map(str, sources)]
        args = Path(out) / "class-path"  # by file: it may be longer than a command line
        args.write_text(f'-cp "{path}"\n')
        done = subprocess.run([*cmd, f"@{args}"], capture_output=True, text=True, timeout=300)
        if done.returncode:
            raise KernelUnavailable(f"kernel did not compile:\n{done.stderr}")
        with tempfile.NamedTemporaryFile(dir=target, suffix=".part", delete=False) as part:
            with zipfile.ZipFile(part, "w", zipfile.ZIP_DEFLATED) as zf:
                for cls in sorted(Path(out).rglob("*.class")):
                    zf.write(cls, cls.relative_to(out))
        os.chmod(part.name, 0o644)
        os.replace(part.name, jar)
    return str(jar)


def enable(spark: SparkSession) -> SparkSession:
    """Make the ``cv_*`` functions known to ``spark``. Safe to call again; returns the session."""
    if spark.catalog.functionExists("cv_area"):
        return spark
    if not hasattr(spark, "_jsparkSession"):
        raise KernelUnavailable("the geometry kernel needs a classic (JVM) session")
    jar = spark.conf.get(_JAR_SETTING, None) or build_jar(spark=spark)
    spark.sql(f"ADD JAR '{jar}'")
    loader = spark._jsparkSession.sharedState().jarClassLoader()
    jvm = spark.sparkContext._jvm
    for name, cls in AGGREGATES.items():
        agg = loader.loadClass(f"coverlay.kernel.{cls}").getDeclaredConstructor(
            spark.sparkContext._gateway.new_array(jvm.java.lang.Class, 0)
        ).newInstance(spark.sparkContext._gateway.new_array(jvm.java.lang.Object, 0))
        udaf = jvm.org.apache.spark.sql.functions.udaf(agg, jvm.org.apache.spark.sql.Encoders.BINARY())
        spark._jsparkSession.udf().register(name, udaf)
    for name, (cls, result) in sorted(FUNCTIONS.items(), key=lambda kv: kv[0] == "cv_area"):
        spark.udf.registerJavaFunction(name, f"coverlay.kernel.Fn${cls}", result)
    return spark
