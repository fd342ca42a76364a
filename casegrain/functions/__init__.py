"""casegrain.functions"""
