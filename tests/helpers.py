"""What tests share besides fixtures."""


def make_star(spark, sales=(), bridge=(), customers=(), products=(), promotions=(), stores=(), dates=()):
    """A small star from literal rows; omitted tables are empty."""
    from martloom import schemas
    from martloom.plans.star import Star

    def frame(name, rows):
        # Literal rows may leave required cells out, so every column is declared nullable here.
        from pyspark.sql.types import StructField, StructType

        fields = [StructField(f.name, f.dataType) for f in schemas.WAREHOUSE[name].fields]
        return spark.createDataFrame(list(rows), StructType(fields))

    return Star(
        DimCustomer=frame("DimCustomer", customers),
        DimDate=frame("DimDate", dates),
        DimProduct=frame("DimProduct", products),
        DimPromotion=frame("DimPromotion", promotions),
        DimStore=frame("DimStore", stores),
        FactSales=frame("FactSales", sales),
        FactProductBridge=frame("FactProductBridge", bridge),
    )


def rows(df):
    return [tuple(r) for r in df.collect()]
