"""Raw order, client, product and region frames derived from the retail benchmark tables.

Fixed expressions of the row's own columns add the defects the cleaning rules
look for; nothing is drawn at random. All rows of every table are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starloom.schemas import ARRIVAL

_schemas: dict[tuple[str, str], StructType] = {}


class RetailTables:
    """Source set over one folder of Parquet tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        """A benchmark table; its schema is read from a file footer once per session."""
        path = f"{self.folder}/{name}.parquet"
        known = _schemas.get((self.spark.sparkContext.applicationId, path))
        if known is not None:
            return self.spark.read.schema(known).parquet(path)
        df = self.spark.read.parquet(path)
        _schemas[self.spark.sparkContext.applicationId, path] = df.schema
        return df

    def orders(self) -> DataFrame:
        """One raw row per order line. Joined small to large, each join on its own key.

        Lines and order heads both grow with the data, so they always meet by a
        shuffle that can spill; Spark would broadcast them where files compress well.
        """
        cities = self.table("nation").select("n_nationkey", "n_name")
        buyers = (
            self.table("customer")
            .select("c_custkey", "c_nationkey")
            .join(cities, F.col("c_nationkey") == F.col("n_nationkey"))
            .select("c_custkey", "n_name")
        )
        heads = (
            self.table("orders")
            .select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
            .join(buyers, F.col("o_custkey") == F.col("c_custkey"))
            .withColumn("jour", F.expr("add_months(cast(o_orderdate as date), 300)"))
        )
        lines = self.table("lineitem").join(heads.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
        return lines.select(
            F.expr("concat('ORD', l_orderkey, '-', l_linenumber)").alias("id_commande"),
            F.expr("concat('C', o_custkey)").alias("id_client"),
            F.expr("concat(if(l_partkey % 50 = 49, 'X', 'P'), l_partkey)").alias("id_produit"),
            F.expr("""
                case when l_orderkey % 20 < 8 then cast(jour as string)
                     when l_orderkey % 20 < 16 then date_format(jour, 'dd/MM/yyyy')
                     when l_orderkey % 20 < 19 then date_format(jour, 'MMM dd yyyy')
                     else 'pas-une-date' end""").alias("date_commande"),
            F.expr("""cast(if((l_orderkey + l_partkey) % 100 = 0, -1, 1)
                * cast(l_quantity as int) as string)""").alias("quantite"),
            F.expr("""if((l_partkey + l_suppkey) % 200 = 0, '0',
                cast(cast(l_extendedprice as decimal(12,2)) as string))""").alias("prix_unitaire"),
            F.expr("""
                case when l_returnflag = 'R' then element_at(array('retourné', 'retourne'), l_linenumber % 2 + 1)
                     when l_returnflag = 'A' and l_linestatus = 'F'
                       then element_at(array('livré', 'livre', 'LIVRE', 'DONE'), l_linenumber % 4 + 1)
                     when l_returnflag = 'A' then element_at(array('OK', 'en_cours'), l_linenumber % 2 + 1)
                     when l_linestatus = 'F' then element_at(array('annulé', 'annule', 'KO'), l_linenumber % 3 + 1)
                     when l_linenumber = 7 then 'xyz'
                     else 'livre' end""").alias("statut"),
            F.expr("""
                case l_partkey % 4 when 0 then upper(n_name) when 1 then lower(n_name)
                     when 2 then concat(' ', n_name, ' ')
                     else if(l_partkey % 16 = 3, 'VilleXYZ', n_name) end""").alias("ville_livraison"),
            F.col("o_orderpriority").alias("mode_paiement"),
            F.expr("if(l_orderkey % 14 = 0, '', concat('L', l_suppkey))").alias("id_livreur"),
            F.expr("""
                if(l_returnflag = 'R' or (l_returnflag = 'A' and l_linestatus = 'F')
                     or (l_returnflag = 'N' and l_linestatus = 'O'),
                   cast(add_months(cast(l_shipdate as date), 300) as string), '')""").alias(
                "date_livraison"
            ),
            F.struct("l_shipdate", "l_partkey", "l_suppkey").alias(ARRIVAL),
        )

    def clients(self) -> DataFrame:
        cities = self.table("nation").select("n_nationkey", "n_name")
        people = self.table("customer").join(cities, F.col("c_nationkey") == F.col("n_nationkey"))
        return people.withColumn("inscrit", F.expr("date_add(date'2020-01-01', cast(c_custkey * 31 % 1600 as int))")).select(
            F.expr("concat('C', c_custkey)").alias("id_client"),
            F.col("c_name").alias("nom"),
            F.expr("concat(' el-', lower(c_mktsegment))").alias("prenom"),
            F.expr("""
                if(c_custkey % 50 = 0, concat(lower(c_mktsegment), c_custkey % 1400),
                   concat(upper(left(c_mktsegment, 1)), lower(substr(c_mktsegment, 2)), '.', c_custkey % 1400,
                          '@mail.com', if(c_custkey % 11 = 0, ' ', '')))""").alias("email"),
            F.expr("""
                if(c_custkey % 40 = 0, 'pas-une-date',
                   cast(date_add(date'1915-01-01', cast(c_custkey * 7919 % 40000 as int)) as string))
                """).alias("date_naissance"),
            F.expr("""
                element_at(array('m', 'F', '1', '0', 'Homme', 'Femme', ' male', 'xyz', 'h'),
                           cast(c_custkey % 9 + 1 as int))""").alias("sexe"),
            F.expr("""
                case c_custkey % 4 when 0 then upper(n_name) when 1 then lower(n_name)
                     when 2 then concat(' ', n_name, ' ')
                     else if(c_custkey % 16 = 3, 'VilleXYZ', n_name) end""").alias("ville"),
            F.lit("").alias("telephone"),
            F.expr("""
                case c_custkey % 3 when 0 then cast(inscrit as string)
                     when 1 then date_format(inscrit, 'dd/MM/yyyy')
                     else date_format(inscrit, 'MMM dd yyyy') end""").alias("date_inscription"),
            F.col("c_mktsegment").alias("canal_acquisition"),
            F.col("c_custkey").alias(ARRIVAL),
        )

    def products(self) -> DataFrame:
        return self.table("part").select(
            F.expr("concat('P', p_partkey)").alias("id_produit"),
            F.col("p_name").alias("nom"),
            F.expr("""
                case p_partkey % 3 when 0 then upper(p_type) when 1 then lower(p_type)
                     else concat(' ', p_type, ' ') end""").alias("categorie"),
            F.col("p_name").alias("sous_categorie"),
            F.expr("concat(' ', p_brand, ' ')").alias("marque"),
            F.expr("concat(' Fournisseur ', p_brand)").alias("fournisseur"),
            F.expr("if(p_partkey % 20 = 0, null, p_retailprice)").alias("prix_catalogue"),
            F.expr("concat('Pays ', p_size)").alias("origine_pays"),
            F.lit("").alias("date_creation"),
            F.expr("p_partkey % 7 <> 0").alias("actif"),
            F.col("p_partkey").alias(ARRIVAL),
        )

    def regions(self) -> DataFrame:
        areas = self.table("region")
        cities = self.table("nation").join(areas, F.col("n_regionkey") == F.col("r_regionkey"))
        return cities.select(
            F.expr("concat('N', n_nationkey)").alias("code_ville"),
            F.col("n_name").alias("nom_ville_standard"),
            F.expr("concat('Province ', n_name)").alias("province"),
            F.col("r_name").alias("region_admin"),
            F.col("r_name").alias("zone_geo"),
            F.lit("").alias("population"),
            F.lit("").alias("code_postal"),
            F.col("n_nationkey").alias(ARRIVAL),
        )
