"""Layered commerce warehouse (ODS -> DIM/DWD -> DWS -> ADS) as Spark DataFrame jobs."""
