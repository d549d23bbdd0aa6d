"""Adapter: the driver's Parquet tables seen as the logical input tables.

The mapping is deterministic, integer arithmetic only, one output row per input row.
"""

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DAY_0 = date(2024, 1, 1)
LAST_DAY = date(2024, 1, 31)
AS_OF = date(2024, 1, 31)


@dataclass
class DriverTables:
    """Logical inputs over one scale-factor directory; each method returns a lazy DataFrame."""

    spark: SparkSession
    path: str

    def raw(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{table}.parquet")

    # -- assignment side ---------------------------------------------------------------------

    @staticmethod
    def _file_of(k: Column) -> Column:
        kind = F.when(k % 5 == 0, "Temprana").when(k % 5 == 1, "CF_ANN").when(k % 5 == 2, "AN")
        kind = kind.when(k % 5 == 3, "Cobranding").otherwise("Otra")
        return F.concat(F.lit("Cartera_Gestion_"), kind, F.lit("_W"), _wave().cast("string"))

    def accounts(self) -> DataFrame:
        """Assignment columns that come from the orders table alone (no join)."""
        k = F.col("o_orderkey")
        priority = F.col("o_orderpriority")
        is_split = F.col("o_orderstatus") == "P"
        return self.raw("orders").select(
            F.col("o_custkey").alias("cod_luna"),
            k.alias("cuenta"),
            F.col("o_custkey").alias("cliente"),
            (F.col("o_custkey") * 10 + k % 10).alias("telefono"),
            F.when(priority == "1-URGENT", "AL VCTO")
            .when(priority == "2-HIGH", "ENTRE 4 Y 15D")
            .when(priority == "3-MEDIUM", "TEMPRANA")
            .when(priority == "5-LOW", F.lit(None))
            .otherwise("TARDIA")
            .alias("tramo_gestion"),
            F.concat(self._file_of(k), F.lit(".txt")).alias("archivo"),
            _due(k).alias("min_vto"),
            F.when(is_split, "SI").otherwise("NO").alias("fraccionamiento"),
            F.when(is_split & (k % 4 > 0), (k % 4).cast("string")).alias("cuota_fracc_act"),
            F.lit(DAY_0).cast("timestamp_ntz").alias("creado_el"),
        )

    def asignacion(self) -> DataFrame:
        """One row per order, with business line and zone of its customer."""
        customer = self.raw("customer").select("c_custkey", "c_nationkey", F.col("c_mktsegment").alias("negocio"))
        nation = self.raw("nation").select("n_nationkey", F.col("n_name").alias("zona"))
        located = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        return (
            self.accounts()
            .join(located, F.col("cod_luna") == F.col("c_custkey"))
            .drop("c_custkey", "c_nationkey", "n_nationkey")
        )

    def calendario(self) -> DataFrame:
        """One row per assignment file. The file name has 5 x 3 values, so 15 rows bound the broadcast."""
        k = F.col("o_orderkey")
        files = (
            self.raw("orders")
            .groupBy(self._file_of(k).alias("ARCHIVO"), _wave().alias("w"))
            .agg(
                F.count_distinct("o_custkey").alias("cant_cod_luna_unique"),
                F.count(F.lit(1)).alias("cant_registros_archivo"),
            )
        )
        start = F.date_add(F.lit(DAY_0), (F.col("w") * 7).cast("int"))
        is_open = F.col("w") == 2
        return files.select(
            "ARCHIVO",
            "cant_cod_luna_unique",
            "cant_registros_archivo",
            start.alias("FECHA_ASIGNACION"),
            start.alias("FECHA_TRANDEUDA"),
            F.when(~is_open, F.date_add(start, 13)).alias("FECHA_CIERRE"),
            F.lit(None).cast("date").alias("VENCIMIENTO"),
            F.lit(14.0).alias("DIAS_GESTION"),
            F.lit(None).cast("double").alias("DIAS_PARA_CIERRE"),
            F.when(is_open, "abierto").otherwise("finalizado").alias("ESTADO"),
        ).hint("broadcast")

    # -- interactions ------------------------------------------------------------------------

    def gestiones_bot(self) -> DataFrame:
        e = F.col("event_id")
        user = F.col("user_id").cast("string")
        kind = F.col("event_type")
        return self.raw("events").where(kind.isin("click", "view")).select(
            F.when(e % 97 == 0, F.concat(F.lit("X"), user)).otherwise(user).alias("document"),
            F.col("ts").alias("date"),
            F.when(e % 23 == 0, F.lit(None))
            .when(kind == "click", "CONTACTO_EFECTIVO")
            .otherwise("NO_CONTESTA")
            .alias("management"),
            F.lit("").alias("sub_management"),
            F.when(e % 5 == 0, "SI").otherwise("").alias("compromiso"),
            F.lit(None).cast("date").alias("fecha_compromiso"),
            F.col("value").alias("duracion"),
        )

    def gestiones_humano(self) -> DataFrame:
        e = F.col("event_id")
        kind = F.col("event_type")
        is_signup = kind == "signup"
        return self.raw("events").where(kind.isin("signup", "error")).select(
            F.col("user_id").cast("string").alias("document"),
            F.col("ts").alias("date"),
            F.when(e % 23 == 0, F.lit(None))
            .when(is_signup, "Compromiso_Pago")
            .otherwise("Contacto_Efectivo")
            .alias("management"),
            F.lit("").alias("sub_management"),
            kind.alias("n1"),
            F.when(e % 2 == 0, " ").otherwise(F.concat(F.lit("N2_"), (e % 3).cast("string"))).alias("n2"),
            F.lit(None).cast("string").alias("n3"),
            F.when(is_signup, F.col("value")).alias("monto_compromiso"),
            F.when(is_signup, F.date_add(F.to_date("ts"), (e % 5).cast("int"))).alias("fecha_compromiso"),
            F.when(e % 11 != 0, F.concat(F.lit("AG_"), (e % 7).cast("string"))).alias("nombre_agente"),
            F.col("value").alias("duracion"),
        )

    # -- debt and payments -------------------------------------------------------------------

    def tran_deuda(self) -> DataFrame:
        k = F.col("o_orderkey")
        dated = F.concat(
            F.lit("TRAN_DEUDA_"),
            F.when(_wave() == 0, "0101").when(_wave() == 1, "0801").otherwise("1501"),
            F.lit(".txt"),
        )
        return self.raw("orders").select(
            k.cast("string").alias("cod_cuenta"),
            F.concat(F.lit("D"), F.col("o_custkey").cast("string")).alias("nro_documento"),
            _due(k).alias("fecha_vencimiento"),
            F.col("o_totalprice").alias("monto_exigible"),
            F.when(k % 13 == 0, "OTRO_ARCHIVO.txt").when(k % 17 == 0, "TRAN_DEUDA_3102.txt").otherwise(dated)
            .alias("archivo"),
            F.lit("2024-01-01 06:00:00").cast("timestamp_ntz").alias("creado_el"),
        )

    def pagos(self) -> DataFrame:
        return self.raw("events").where(F.col("event_type") == "purchase").select(
            F.col("event_id").cast("string").alias("cod_sistema"),
            F.concat(F.lit("D"), F.col("user_id").cast("string")).alias("nro_documento"),
            F.col("value").alias("monto_cancelado"),
            F.col("ts").alias("fecha_pago"),
            F.lit("PAGOS").alias("archivo"),
        )

    # -- lookup tables (literal rows: their size is known to the optimizer) --------------------

    def homolog_bot(self) -> DataFrame:
        return self.spark.sql(
            """SELECT * FROM VALUES
              ('CONTACTO_EFECTIVO', '', '',   'CONTACTO',     'N1A', 'N2A', 0),
              ('CONTACTO_EFECTIVO', '', 'SI', 'PROMESA',      'N1B', 'N2B', 1),
              ('NO_CONTESTA',       '', '',   'SIN_CONTACTO', 'N1C', 'N2C', 0)
            AS t(bot_management, bot_sub_management, bot_compromiso, contactabilidad_homologada,
                 n1_homologado, n2_homologado, es_pdp_homologado)"""
        )

    def homolog_humano(self) -> DataFrame:
        return self.spark.sql(
            """SELECT * FROM VALUES
              ('Compromiso_Pago',   'PROMESA',  'N1D', 'N2D', 'si'),
              ('Contacto_Efectivo', 'CONTACTO', 'N1E', CAST(NULL AS STRING), 'NO')
            AS t(management, contactabilidad, n_1, n_2, pdp)"""
        )

    def homolog_usuarios(self) -> DataFrame:
        return self.spark.sql(
            "SELECT * FROM VALUES ('AG_0', 'AGENTE_CERO'), ('AG_1', 'AGENTE_UNO') AS t(usuario, usuario_homologado)"
        )


def _wave() -> Column:
    return F.expr("o_orderkey div 5 % 3")


def _due(k: Column) -> Column:
    return F.when(k % 10 != 0, F.date_add(F.lit(date(2023, 12, 15)), (k % 160).cast("int")))
