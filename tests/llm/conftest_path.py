SMALL = "/root/testdata/sf0.001"
