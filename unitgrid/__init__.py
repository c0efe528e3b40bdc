"""unitgrid: monthly statistics per administrative unit, as Spark DataFrame operators."""
