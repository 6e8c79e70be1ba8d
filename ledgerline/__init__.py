"""ledgerline: sales and profitability analytics on Spark.

Flat order lines → cleaning → star schema → load checks, views, measures,
reports and product-identifier conflict reports, each a DataFrame function.
"""
