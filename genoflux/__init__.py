"""DNA-barcode genotyping and biogeography on Spark."""
